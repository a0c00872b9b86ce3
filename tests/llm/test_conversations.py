"""Conversation repair against a recursive search over edits."""

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
import xxhash

from tagstream.llm import conversations as cv
from tests.llm.helpers import table

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def spark_hash(role, text):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x
    h = xxhash.xxh64(role.encode(), seed=42).intdigest()
    return signed(xxhash.xxh64(text.encode(), seed=h).intdigest())


def brute(rows):
    """Result per conversation of (conv_id, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        mine += [(turn, role, text)] * (2 if d == 3 else 1)
    return {c: one(r) for c, r in convs.items()}


def one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, spark_hash(r[1], r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        full = re.sub("[ \t\n\x0b\x0c\r]+$", "", text)
        faults.append("blank" if not full else "duplicate" if (role, text) in seen
                      else "truncated" if full[-1] not in ".!?" else "")
        seen.add((role, text))
    init = [r[1][:1] for r in rows]

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 2:
            c, a, e = best(i, NEXT[state], inserted + 1)
            options.append((c + 5, "I" + a, ((-1, ROLE[NEXT[state]]), *e)))
        if i < len(rows):
            c, a, e = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, e))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if init[i] and (init[i] == NEXT[state] or (state == "" and init[i] == "s")):
                    c, a, e = best(i + 1, init[i], 0)
                    options.append((c + more, "K" + a, ((i, rows[i][1]), *e)))
                c, a, e = best(i + 1, NEXT[state], 0)
                options.append((c + 1 + more, "R" + a, ((i, ROLE[NEXT[state]]), *e)))
        return min(options, key=lambda o: o[:2]) if options else (10 ** 9, "", ())

    cost, audit, edits = best(0, "", 0)
    text = "\n".join(f"{role}:{rows[i][2] if i >= 0 else ''}" for i, role in edits)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") or not a for a, b in zip(init, init[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def repaired(spark, rows, parts=3, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    out = cv.repair(df, **how).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def test_equal_to_search_on_a_table(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations")]
    assert repaired(spark, rows) == brute(rows)


def random_rows(seed, n_conv, n_turn):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "agent"]
    texts = ["Hi.", "Yes!", "No", "", " \n", None, "Why?", "Hi. ", "éß.", "end\x1f"]
    return [(int(c), None if rng.random() < 0.05 else int(rng.integers(0, n_turn * 2)),
             roles[rng.choice(7, p=[.4, .35, .1, .05, .04, .03, .03])], texts[rng.integers(0, len(texts))])
            for c in range(n_conv) for _ in range(rng.integers(1, n_turn + 1))]


def test_awkward_rows(spark):
    rows = random_rows(3, 150, 12)
    rows += [(None, 1, "user", "A."), (None, None, None, None), (10 ** 12, 5, "user", "same.")] + [(7, 3, "user", "R.")] * 40
    rows += [(500 + k, 0, "user", "x" * 200_000 + ".") for k in range(3)]
    assert repaired(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [1, 3, 8])
def test_long_conversations_lie_in_many_segments(spark, size):
    rows = random_rows(size, 4, 70) + [(50, t, "user" if t % 2 else "assistant", f"t{t // 3}.") for t in range(150)]
    assert repaired(spark, rows, 6, segment_rows=size) == brute(rows)


def test_no_rows(spark):
    assert repaired(spark, []) == {}


def test_a_dropped_conversation_has_zeros(spark):
    gone = next((c, 0, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [gone]) == {gone[0]: (0, 0, 0, 0, 0, 0, "", empty)}


def test_extra_columns_that_clash(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 5, True), (1, 1, "assistant", "Yes.", "y", 6, False)],
                               "conv_id long, turn long, role string, text string, audit string, cost int, whole boolean")
    assert cv.repair(df).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                     "repaired_sha256"]


def test_least_audit_among_equal_costs():
    # two rows of user: delete one of them (2) or make the second assistant (1)
    s = cv.Solver([np.array([2, 2], np.uint8)], np.array([[0, cv._FAR, cv._FAR, 0]]), np.array([True]))
    (audit, made), = s.edits(np.array([0]), np.array([0]))
    assert audit == "KR" and made == [(0, None), (1, "assistant")]
