import corpus_pipeline as C
from tagstream.llm import quality as Q
from tagstream.session import materialize
from tagstream.sources.tables import read_table
from tests.llm import test_bpe, test_decontaminate, test_neardup, test_quality
from tests.llm.helpers import table

SMALL = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_each_stage_equals_brute_force_on_its_own_input(spark):
    docs = read_table(spark, SMALL, "documents")
    judge = Q.Judge(Q.language_references(docs))
    columns, before = docs.columns, texts(docs)
    for name, stage in C.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SMALL), f"test-{name}")
        after = texts(docs)
        assert docs.columns == columns and set(after) <= set(before) and after
        if name != "pii":
            assert all(before[i] == t for i, t in after.items())
        if name == "quality":
            want = set()
            for i, t in before.items():
                n, *_, repeated = test_quality.brute(t) if len(t) < 3000 else Q.measure(t)
                if n >= 50 and 100 * repeated <= 50 * n and judge.keeps(judge.distances(t)):
                    want.add(i)
            assert set(after) == want
        elif name == "neardup":
            want = test_neardup.brute(list(before.items()), 5)
            assert set(after) == {i for i, (_, c) in want.items() if i == c}
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in table("benchmark", SMALL)]
            want = test_decontaminate.brute(list(before.values()), items)
            assert set(after) == {i for i, w in zip(before, want) if not w[-1]}
        else:
            assert set(after) == set(before)
        before = after
    out = {r["doc_id"]: r for r in C.STAGES[-1][1](spark, docs, SMALL).collect()}
    assert set(out) == set(before)
    for i, t in before.items():
        assert list(out[i]["ids"]) == list(test_bpe.library(t)[0]), i
