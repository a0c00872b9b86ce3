"""Repair of conversation structure by a cheapest edit path.

A conversation's rows, by turn, are to give role initials ``(s?(ua)+)?``.  An
edit keeps a row (K, cost 0), gives it the role user or assistant (R, 1),
deletes it (D, 2; blank and repeated rows must go) or inserts an empty row of
user or assistant (I, 5); a truncated row that stays costs 5 more.  Nodes are
(row, state of the pattern), arcs are edits:

1. cost DP: the cost to go of every node, level by level from the end, for
   all conversations of a batch at once; *optimal arcs* lie on cheapest paths;
2. path ranking by prefix doubling: nodes are ranked by their least audit of
   1, 2, 4, ... letters, each round joining a node's rank with that of the
   node 2^k letters on; the ranks choose among optimal arcs, and the doubled
   pointers give the node at every place of the least path at once.

Long conversations: rows are range-partitioned by (conversation, turn), so a
conversation may lie in many partitions, and are cut into *segments* of at
most ``SEGMENT_ROWS`` rows.  Conversations inside a partition are solved where
they are.  Of the others, each segment gives a (min, +) matrix of its costs
between pattern states; a scan over the matrices gives the cost to go at each
segment's end, segments rank their paths from every entry state, a second
scan over the exits gives the entry states, and the segments are solved side
by side.  Repeats across segments are found by an aggregate over digests.  The
digest of a conversation's repaired text is sequential by nature: one task
reads its segments in order, holding one at a time.

Fixed rules: see ``damage``.  Defined cases: null role and text read as one
space, null ids and turns too in the damage rule; a null conversation id is a
conversation of its own; null turns come first; rows of one turn are ordered by
a hash of role and text; a role without letters has no initial and can't be
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.session import materialize

SEGMENT_ROWS = 1024
SEGMENT_CHARS = 4 << 20
#: Rows that are solved at once.
BATCH_ROWS = 16_384

_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
# A row's kind, one byte: class of its role's initial, and its fault.
_CLASS, _BLANK, _REPEAT, _CUT = 3, 4, 8, 16
_CLASSES = {"s": 1, "u": 2, "a": 3}
# Pattern states: nothing yet, after s, after u, after a.
_START, _S, _U, _A = range(4)
_NEXT = np.array([_U, _U, _A, _U])  # after an inserted or re-roled row
_KEEP = np.full((4, 4), -1)  # state, class of the initial -> state
_KEEP[_START, 1], _KEEP[_START, 2], _KEEP[_S, 2], _KEEP[_U, 3], _KEEP[_A, 2] = _S, _U, _U, _A, _U
_ENDS = np.array([0, _FAR, _FAR, 0])  # cost to go when no row is left, before insertions
_LETTERS = b".DIKR"  # in ASCII order; 0 is the end
_ROLE = {_U: "user", _A: "assistant"}


def damage(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Damages rows by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 sets
    the role user.  A dropped row stays as a mark (``gone``) that its
    conversation exists."""
    c = conversations.select(
        F.col(id_col).alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit(" ")) for k in ("conv_id", "turn")])
    c = c.withColumn("_d", F.crc32(F.encode(key, "UTF-8")) % 20)
    d = F.col("_d")
    c = c.withColumn("_copy", F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return c.select(
        "conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when((d == 0) | (d == 1), "").when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (d == 0).alias("gone"))


# ------------------------------------------------------------ the solver ----

class Solver:
    """Cheapest least paths of a batch of segments.

    ``kinds``: uint8 array per segment.  ``ends``: per segment the cost to go
    from each state at its end; where ``last``, insertions may follow there."""

    def __init__(self, kinds: list[np.ndarray], ends: np.ndarray, last: np.ndarray):
        n = len(kinds)
        self.rows = np.array([len(k) for k in kinds], np.int64)
        self.first = np.concatenate([[0], np.cumsum((self.rows + 1) * 4)])[:-1]
        total = int(((self.rows + 1) * 4).sum())
        self.cost = np.full(total, _FAR, np.int64)
        arcs = np.full((total, 5), -1, np.int64)  # targets by letter
        flat = np.concatenate([*kinds, np.zeros(1, np.uint8)])
        starts = np.concatenate([[0], np.cumsum(self.rows)])
        order = np.argsort(-self.rows, kind="stable")
        q = np.arange(4)
        # the end of every segment
        node = self.first[:, None] + self.rows[:, None] * 4 + q
        cost = np.where(last[:, None], self._insert(ends), ends)
        self.cost[node] = cost
        arcs[node, 0] = node
        more = last[:, None] & (cost < ends)
        arcs[node[more], 0] = -1
        arcs[node[more], 2] = (node - q + _NEXT)[more]
        for level in range(int(self.rows.max(initial=0)) - 1, -1, -1):
            s = order[:int((self.rows > level).sum())]
            kind = flat[starts[s] + level]
            node = self.first[s][:, None] + level * 4 + q
            after = node + 4 - q
            later = self.cost[node + 4]
            stay = (kind & (_BLANK | _REPEAT)) == 0
            extra = np.where(kind & _CUT, 5, 0)[:, None] + np.where(stay, 0, _FAR)[:, None]
            keep = _KEEP[q, (kind & _CLASS)[:, None]]
            row = np.arange(len(s))[:, None]
            by = [2 + later, None, np.where(keep >= 0, later[row, keep] + extra, _FAR), 1 + extra + later[:, _NEXT]]
            cost = np.minimum(np.minimum(by[0], by[2]), by[3])
            cost = self._insert(cost)
            by[1] = 5 + cost[:, _NEXT]
            cost = np.minimum(cost, _FAR)
            self.cost[node] = cost
            for letter, to in ((1, node + 4), (2, node - q + _NEXT), (3, after + keep), (4, after + _NEXT)):
                ok = (by[letter - 1] == cost) & (cost < _FAR)
                arcs[node[ok], letter] = to[ok]
        self._rank(arcs)

    @staticmethod
    def _insert(cost: np.ndarray) -> np.ndarray:
        """Up to two insertions first; more never help."""
        for _ in range(2):
            cost = np.minimum(cost, 5 + cost[:, _NEXT])
        return cost

    def _rank(self, arcs: np.ndarray) -> None:
        """Ranks of audits by prefix doubling; the pointers 2^k letters on."""
        every = np.arange(len(arcs))
        dead = (arcs < 0).all(axis=1)  # no way on: an end that no path uses
        arcs[dead, 0] = every[dead]
        # a letter leads to one node only, so the least letter's arc is first
        letter = (arcs >= 0).argmax(axis=1)
        rank, to, n = letter, arcs[every, letter], (letter > 0).astype(np.int64)
        while letter[to].any():
            _, rank = np.unique(rank.astype(np.int64) * (int(rank.max()) + 1) + rank[to], return_inverse=True)
            n = n + n[to]
            to = to[to]
        # among optimal arcs: the least letter, then the least rank behind it
        size = int(rank.max(initial=0)) + 1
        key = np.where(arcs >= 0, np.arange(5) * size + rank[arcs], 5 * size)
        self.letter = key.argmin(axis=1)
        self.step = arcs[every, self.letter]
        self.length = n

    def paths(self, segments: np.ndarray, states: np.ndarray):
        """(nodes, bounds): the nodes of the least paths from the begin of
        the segments in the given states, one after the other."""
        begin = self.first[segments] + states
        length = self.length[begin]
        bounds = np.concatenate([[0], np.cumsum(length)])
        nodes = np.repeat(begin, length)
        place = np.arange(len(nodes)) - np.repeat(bounds[:-1], length)
        to, k = self.step, 0
        while len(place) and (int(place.max()) >> k):
            odd = (place >> k & 1).astype(bool)
            nodes[odd] = to[nodes[odd]]
            to, k = to[to], k + 1
        return nodes, bounds

    def exits(self) -> np.ndarray:
        """State in which the path from each entry state leaves a segment."""
        at = self.first[:, None] + np.arange(4)
        to = self.step
        while self.letter[to].any():
            to = to[to]
        end = to[at]
        return (end - self.first[:, None]) % 4

    def edits(self, segments: np.ndarray, states: np.ndarray):
        """Per segment (audit, [(row or -1, new role or None), ...])."""
        nodes, bounds = self.paths(segments, states)
        inside = nodes - np.repeat(self.first[segments], np.diff(bounds))
        letters = self.letter[nodes]
        audit = np.frombuffer(_LETTERS, np.uint8)[letters].tobytes().decode()
        row, state = (inside // 4).tolist(), ((self.step[nodes] - nodes + inside) % 4).tolist()
        letters = letters.tolist()
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            made = [(row[k] if letters[k] > 2 else -1, None if letters[k] == 3 else _ROLE[state[k]])
                    for k in range(a, b) if letters[k] > 1]
            yield audit[a:b], made


def _lines(made, roles: list[str], texts: list[str]) -> list[str]:
    return [f"{roles[r] if role is None else role}:{texts[r] if r >= 0 else ''}" for r, role in made]


def _kind(role: str, text: str, repeat: bool) -> int:
    kind = _CLASSES.get(role[:1], 0)
    full = text.rstrip(_SPACE)
    if not full:
        return kind | _BLANK
    if repeat:
        return kind | _REPEAT
    return kind | (0 if full[-1] in ".!?" else _CUT)


def _illegal(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    pair = (first & _CLASS).astype(int) * 4 + (second & _CLASS)
    return ~np.isin(pair, [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])


def _counts(kinds: np.ndarray) -> list[int]:
    """blank, duplicate, truncated, illegal inside."""
    return [int(((kinds & bit) > 0).sum()) for bit in (_BLANK, _REPEAT, _CUT)] + [
        int(_illegal(kinds[:-1], kinds[1:]).sum())]


# -------------------------------------------------------------- operator ----

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SEGMENT = ("part int, seg int, kinds binary, digests binary, tmin long, tmax long, tdistinct long, "
            "roles array<string>, texts array<string>")


def _digest(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


class _Held:
    """The rows of one conversation that a task has read."""

    def __init__(self, conv):
        self.conv, self.n_segments = conv, 0
        self.clear()

    def clear(self):
        self.roles, self.texts, self.kinds, self.turns = [], [], [], []
        self.seen, self.chars = set(), 0

    def add(self, turn, role, text):
        key = (role, text)
        kind = _kind(role, text, key in self.seen)
        self.seen.add(key)
        self.roles.append(role)
        self.texts.append(text)
        self.kinds.append(kind)
        if turn is not None:
            self.turns.append(turn)
        self.chars += len(text)

    def full(self, rows: int) -> bool:
        return len(self.kinds) >= rows or self.chars >= SEGMENT_CHARS


def _segments(rows: DataFrame, names: list[str], schema: str, segment_rows: int) -> DataFrame:
    """Results of the conversations that lie inside a partition, segments of
    the others."""
    n_result = len(names) - 9 - 2

    def run(batches):
        part = TaskContext.get().partitionId()
        held, first, n_segments, solved, waiting = None, True, 0, [], []
        waiting_rows = waiting_chars = 0

        def out(rows_):
            cols = list(zip(*rows_))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names=names)

        def segment():
            nonlocal n_segments
            h = held
            digests = b"".join(bytes(16) if k & (_BLANK | _REPEAT) else _digest(r, t)
                               for k, r, t in zip(h.kinds, h.roles, h.texts))
            row = (h.conv, False, *[None] * n_result, part, n_segments, bytes(h.kinds), digests,
                   min(h.turns, default=None), max(h.turns, default=None), len(set(h.turns)), h.roles, h.texts)
            n_segments += 1
            h.n_segments += 1
            h.clear()
            return row

        def solve():
            kinds = [np.array(h.kinds, np.uint8) for h in waiting]
            n = len(waiting)
            s = Solver(kinds, np.tile(_ENDS, (n, 1)), np.ones(n, bool))
            got = s.edits(np.arange(n), np.zeros(n, np.int64))
            for k, (h, (audit, made)) in enumerate(zip(waiting, got)):
                text = "\n".join(_lines(made, h.roles, h.texts))
                gaps = max(h.turns) - min(h.turns) + 1 - len(set(h.turns)) if h.turns else 0
                yield (h.conv, True, gaps, *_counts(kinds[k]), int(s.cost[s.first[k]]), audit,
                       hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), *[None] * 9)

        types = None
        for batch in batches:
            if types is None:
                types = [batch.schema.field("conv_id").type, pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string(),
                         pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3,
                         pa.list_(pa.string()), pa.list_(pa.string())]
            for conv, turn, role, text, gone in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if held is None or conv != held.conv:
                    if held is not None:
                        if first or held.n_segments:
                            solved.append(segment())
                        else:
                            waiting.append(held)
                            waiting_rows += len(held.kinds) + 1
                            waiting_chars += held.chars
                        first = False
                    held = _Held(conv)
                elif held.full(segment_rows):
                    solved.append(segment())
                if not gone:
                    held.add(turn, role, text)
                if waiting_rows > BATCH_ROWS or waiting_chars > 4 * SEGMENT_CHARS:
                    solved += solve()
                    waiting, waiting_rows, waiting_chars = [], 0, 0
                if len(solved) >= 4096 or (len(solved) >= 8 and solved[-1][-1]):  # few that hold texts
                    yield out(solved)
                    solved = []
        if held is not None:
            solved.append(segment())
        if waiting:
            solved += solve()
        if solved:
            yield out(solved)

    return rows.mapInArrow(run, schema)


def repair(conversations: DataFrame, id_col: str = "conv_id", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Damage, then repair: per conversation conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.  ``segment_rows`` (4,095
    at most) only affects how the work is cut."""
    if not 0 < segment_rows < 1 << 12:
        raise ValueError("segment_rows must lie between 1 and 4095")
    rows = damage(conversations, id_col)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.withColumn("_h", F.xxhash64("role", "text"))
    # equal rows of one turn may be any number: the last key parts them
    rows = rows.withColumn("_s", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "_h", "_s"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.select("conv_id", "turn", "role", "text", "gone")
    schema = f"conv_id {id_type}, whole boolean, {_RESULT}, {_SEGMENT}"
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    out = materialize(_segments(rows, names, schema, segment_rows), "conversations")
    results = [n for n in names[:10] if n != "whole"]
    whole = out.where("whole").select(*results)
    return whole.unionByName(_solve_open(out.where("not whole"), id_type, results))


def _solve_open(segs: DataFrame, id_type: str, results: list[str]) -> DataFrame:
    """Conversations whose segments may lie in several partitions."""
    kinds = _across(segs, id_type)
    ends = _costs_to_go(kinds, id_type)
    solved = materialize(_exits(kinds.join(ends, ["part", "seg"]), id_type), "conversation-exits")
    entries = _entries(solved, id_type)
    todo = segs.select("conv_id", "part", "seg", "roles", "texts").join(
        solved.select("part", "seg", "kinds", "ends", "last"), ["part", "seg"]).join(entries, ["part", "seg"])
    pieces = _pieces(todo, id_type)
    pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return _joined(pieces, id_type).select(*results)


def _across(segs: DataFrame, id_type: str) -> DataFrame:
    """Kinds of all rows once repeats across segments are known, and each
    segment's costs between states."""
    def firsts(batches):
        for batch in batches:
            for conv, part, seg, kinds, digests in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                own = [i for i, k in enumerate(kinds) if not k & (_BLANK | _REPEAT)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(own), batch.schema.field(0).type),
                     pa.array([digests[16 * i:16 * i + 16] for i in own], pa.binary()),
                     pa.array([part] * len(own), pa.int32()), pa.array([seg] * len(own), pa.int32()),
                     pa.array(own, pa.int32())], names=["conv_id", "digest", "part", "seg", "idx"])

    own = segs.select("conv_id", "part", "seg", "kinds", "digests").mapInArrow(
        firsts, f"conv_id {id_type}, digest binary, part int, seg int, idx int")
    place = F.col("part").cast("long") * (1 << 42) + F.col("seg").cast("long") * (1 << 12) + F.col("idx")
    # a segment's number times 2^12 leaves room for the rows of one segment
    first = own.groupBy("conv_id", "digest").agg(F.min(place).alias("p"))
    first = first.groupBy(F.shiftright("p", 42).cast("int").alias("part"),
                          (F.shiftright("p", 12).bitwiseAND((1 << 30) - 1)).cast("int").alias("seg")).agg(
        F.collect_list(F.col("p").bitwiseAND((1 << 12) - 1).cast("int")).alias("new"))
    got = segs.select("conv_id", "part", "seg", "kinds", "tmin", "tmax", "tdistinct").join(first, ["part", "seg"], "left")

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            kinds = []
            for r in rows:
                k = np.frombuffer(r["kinds"], np.uint8).copy()
                old = (k & (_BLANK | _REPEAT)) == 0
                old[np.array(r["new"] or [], np.int64)] = False
                k[old] = k[old] & _CLASS | _REPEAT
                kinds.append(k)
            n = len(rows)
            matrix = np.empty((n, 4, 4), np.int64)
            for a in range(0, n, 16):
                some = kinds[a:a + 16]
                for q in range(4):
                    end = np.full((len(some), 4), _FAR)
                    end[:, q] = 0
                    s = Solver(some, end, np.zeros(len(some), bool))
                    matrix[a:a + 16, :, q] = s.cost[s.first[:, None] + np.arange(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index(c)) for c in ("conv_id", "part", "seg")]
                + [pa.array([k.tobytes() for k in kinds], pa.binary())]
                + [batch.column(names.index(c)) for c in ("tmin", "tmax", "tdistinct")]
                + [pa.array(matrix.reshape(n, 16).tolist(), pa.list_(pa.int64()))],
                names=["conv_id", "part", "seg", "kinds", "tmin", "tmax", "tdistinct", "matrix"])

    names = got.columns
    schema = (f"conv_id {id_type}, part int, seg int, kinds binary, tmin long, tmax long, tdistinct long, "
              "matrix array<long>")
    return materialize(got.mapInArrow(run, schema), "conversation-kinds")


def _costs_to_go(kinds: DataFrame, id_type: str) -> DataFrame:
    """Scan from the last segment of a conversation to its first: cost to go
    at each segment's end, and at its begin."""
    rows = kinds.select("conv_id", "part", "seg", "matrix").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), F.col("part").desc(), F.col("seg").desc())

    def run(batches):
        conv, ends, started = None, None, False
        for batch in batches:
            cols = [[], [], [], [], []]
            for c, part, seg, m in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                last = not started or c != conv
                if last:
                    ends = _ENDS
                conv, started = c, True
                cols[0].append(part)
                cols[1].append(seg)
                cols[2].append(ends.tolist())
                cols[3].append(last)
                after = Solver._insert(ends[None])[0] if last else ends
                ends = np.minimum((np.array(m).reshape(4, 4) + after).min(axis=1), _FAR)
                cols[4].append(int(ends[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.int64())),
                 pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.int64())],
                names=["part", "seg", "ends", "last", "cost"])

    return rows.mapInArrow(run, "part int, seg int, ends array<long>, last boolean, cost long")


def _exits(rows: DataFrame, id_type: str) -> DataFrame:
    """Adds the state in which each entry state's path leaves the segment,
    and the segment's counts."""
    names = ["conv_id", "part", "seg", "kinds", "tmin", "tmax", "tdistinct", "ends", "last", "cost"]

    def run(batches):
        for batch in batches:
            kinds = [np.frombuffer(k, np.uint8) for k in batch.column(3).to_pylist()]
            ends = np.array(batch.column(7).to_pylist(), np.int64).reshape(-1, 4)
            last = np.array(batch.column(8).to_pylist(), bool)
            exits = []
            for a in range(0, len(kinds), 16):
                exits += Solver(kinds[a:a + 16], ends[a:a + 16], last[a:a + 16]).exits().tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(exits, pa.list_(pa.int64())),
                 pa.array([_counts(k) for k in kinds], pa.list_(pa.int64()))], names=[*names, "exits", "counts"])

    schema = (f"conv_id {id_type}, part int, seg int, kinds binary, tmin long, tmax long, tdistinct long, "
              "ends array<long>, last boolean, cost long, exits array<long>, counts array<long>")
    return rows.select(*names).mapInArrow(run, schema)


def _entries(solved: DataFrame, id_type: str) -> DataFrame:
    """Scan from the first segment to the last: each segment's entry state
    and the conversation's counts up to it."""
    edges = [F.substring("kinds", 1, 1).alias("head"), F.substring("kinds", -1, 1).alias("tail")]
    rows = solved.select("conv_id", "part", "seg", "tmin", "tmax", "tdistinct", "cost", "exits", "counts", *edges)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")

    def run(batches):
        conv, started = None, False
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if not started or r["conv_id"] != conv:
                    conv, started = r["conv_id"], True
                    state, cost, sums, tail = 0, r["cost"], [0] * 4, b""
                    low = high = None
                    distinct = 0
                if tail and r["head"]:
                    sums[3] += int(_illegal(np.frombuffer(tail, np.uint8), np.frombuffer(r["head"], np.uint8))[0])
                tail = r["tail"] or tail
                sums = [a + b for a, b in zip(sums, r["counts"])]
                if r["tmin"] is not None:
                    distinct += r["tdistinct"] - (high == r["tmin"])
                    low, high = r["tmin"] if low is None else low, r["tmax"]
                gaps = high - low + 1 - distinct if low is not None else 0
                out.append({"part": r["part"], "seg": r["seg"], "entry": state, "totals": [gaps, *sums, cost]})
                state = r["exits"][state]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("part", pa.int32()), ("seg", pa.int32()), ("entry", pa.int32()), ("totals", pa.list_(pa.int64()))]))

    return rows.mapInArrow(run, "part int, seg int, entry int, totals array<long>")


def _pieces(todo: DataFrame, id_type: str) -> DataFrame:
    """Audit and repaired lines of every segment."""
    names = ["conv_id", "part", "seg", "totals", "kinds", "ends", "last", "entry", "roles", "texts"]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 16):
                batch = whole.slice(at, 16)
                cols = [c.to_pylist() for c in batch.columns]
                kinds = [np.frombuffer(k, np.uint8) for k in cols[4]]
                s = Solver(kinds, np.array(cols[5], np.int64).reshape(-1, 4), np.array(cols[6], bool))
                audits, lines = [], []
                for k, (audit, made) in enumerate(s.edits(np.arange(len(kinds)), np.array(cols[7], np.int64))):
                    audits.append(audit)
                    got = _lines(made, cols[8][k], cols[9][k])
                    lines.append("\n".join(got) if got else None)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(audits, pa.string()), pa.array(lines, pa.string())],
                                                 names=["conv_id", "part", "seg", "totals", "audit", "lines"])

    return todo.select(*names).mapInArrow(
        run, f"conv_id {id_type}, part int, seg int, totals array<long>, audit string, lines string")


def _joined(pieces: DataFrame, id_type: str) -> DataFrame:
    """A row per conversation from its pieces in order."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches):
        conv, digest, audit, totals, any_lines, kind = None, None, [], None, False, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), *[pa.array([v], pa.int64()) for v in totals], pa.array(["".join(audit)]),
                 pa.array([digest.hexdigest()])], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, _, _, sums, letters, lines in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                if digest is None or c != conv:
                    if digest is not None:
                        yield row()
                    conv, digest, audit, any_lines = c, hashlib.sha256(), [], False
                if lines is not None:
                    digest.update((("\n" if any_lines else "") + lines).encode("utf-8", "surrogatepass"))
                    any_lines = True
                audit.append(letters)
                totals = sums
        if digest is not None:
            yield row()

    return pieces.mapInArrow(run, f"conv_id {id_type}, {_RESULT}")
