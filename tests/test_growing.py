"""Following files that grow."""

import os

import pytest

from tagstream.sources import growing as G


def _append(path, text, mode="ab"):
    with open(path, mode) as f:
        f.write(text.encode())


def _got(df):
    return sorted((r["file"], r["byte"], r["value"]) for r in df.collect())


def _lines_of(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        at = 0
        with open(f"{folder}/{name}", "rb") as f:
            for line in f:
                if line.endswith(b"\n"):
                    out.append((name, at, line[:-1].decode("utf-8", "replace")))
                at += len(line)
    return sorted(out)


@pytest.mark.parametrize("max_lines", [None, 3])
def test_appended_lines_arrive_once_and_restart_goes_on(spark, tmp_dir, max_lines):
    src, out, ck = (f"{tmp_dir}/{x}" for x in ("in", "out", "ck"))
    os.makedirs(src)

    def run():
        return G.drain(G.follow_lines(spark, src, max_lines, range_bytes=7), out, ck)

    _append(f"{src}/a.log", "one\ntwo\n\nthr")
    assert _got(run()) == [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "")]
    _append(f"{src}/a.log", "ee\n" + "x" * 50 + "\né\n")  # the unfinished line is finished
    _append(f"{src}/b.log", "b1\r\nb2\n" * 5)
    assert _got(run()) == _lines_of(src)
    assert _got(run()) == _lines_of(src)  # nothing new
    _append(f"{src}/b.log", "last\nopen")
    assert _got(run()) == _lines_of(src)


def test_cap_on_the_lines_of_a_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for name in "ab":
        _append(f"{src}/{name}", "".join(f"{name}{k}\n" for k in range(25)))
    sizes, seen = [], []
    s = G.follow_lines(spark, src, max_lines=20)
    q = s.writeStream.foreachBatch(lambda b, i: (sizes.append(b.count()), seen.extend(r["value"] for r in b.collect()))) \
        .option("checkpointLocation", f"{tmp_dir}/ck").start()
    q.processAllAvailable()
    q.stop()
    assert sizes == [20, 20, 10]
    assert sorted(seen) == sorted(f"{n}{k}" for n in "ab" for k in range(25))


def test_a_file_written_anew_is_read_from_its_begin(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/{x}" for x in ("in", "out", "ck"))
    os.makedirs(src)
    run = lambda: sorted((r["gen"], r["value"]) for r in G.drain(G.follow_lines(spark, src), out, ck).collect())
    _append(f"{src}/c", "a\nb\n")
    assert run() == [(0, "a"), (0, "b")]
    _append(f"{src}/c", "z\n", "wb")  # shorter
    assert run() == [(0, "a"), (0, "b"), (1, "z")]
    _append(f"{src}/c", "y\nw\nv\n", "wb")  # longer, other first bytes
    assert run() == [(0, "a"), (0, "b"), (1, "z"), (2, "v"), (2, "w"), (2, "y")]


def test_ranges_hold_every_line_once(tmp_dir):
    text = b"".join(b"%d" % k * (k % 23) + b"\n" for k in range(300))
    with open(f"{tmp_dir}/f", "wb") as f:
        f.write(text)
    want, at = [], 0
    for line in text.split(b"\n")[:-1]:
        want.append((at, line))
        at += len(line) + 1
    for size in (1, 2, 13, 100, 5000, 1 << 20):
        reader = G.RangeReader({"path": f"{tmp_dir}/f", "range_bytes": str(size)})
        end = reader.latestOffset()
        got = []
        with open(f"{tmp_dir}/f", "rb") as f:
            for r in reader.partitions({}, end):
                got += G._lines(f, r.begin, r.end, r.stop, r.at_line)
        assert got == want
        assert reader.partitions(end, end) == []


def test_a_path_that_is_not_there_yet(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/{x}" for x in ("in", "out", "ck"))
    run = lambda: G.drain(G.follow_lines(spark, src), out, ck).count()
    os.makedirs(out)
    assert run() == 0
    _append(src, "now\n")  # a file of its own
    assert run() == 1
