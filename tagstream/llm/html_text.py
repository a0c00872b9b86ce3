"""Main text by equivalence-class template deduction.

Pages of one host are filled from templates.  A token is a tag with the path of
structural elements around it, or a whole text run.  Its role also says in
which gap of the template it stands, so one tag may have several roles.  A role has an
occurrence vector: how often it occurs on each page of the host.  Roles of one gap
with equal vectors form an equivalence class.  The template grows in rounds:

1. vectors of all roles under the template found so far, and their classes with
   enough support and members;
2. a class whose vector is that of the class around it belongs to that one (on the page
   itself this gives the root: what occurs exactly once on every page);
3. each class is held against every page: members that do not come in one
   order, or not within one gap, are taken out of it (they stay roles, and new
   gaps may part them); classes too small after that fall;
4. of classes that overlap, the outer one is taken, and where they cross or change
   places the one on more pages; the others are seen again in its gaps.

A class that is taken nests in the gap of another one and splits the roles in its
own gaps; rounds go on until nothing more is taken.  What lies in a gap and
is no member of a class fills a slot; the
slots under the article (or, without one, outside boilerplate elements, less
blocks that are all template text) hold the main text.  Elements are marked as
boilerplate by whole class tokens, id or role; marks on html, body, the main
element and the elements around it do not count.

Pages are read into tokens once; copies of a page (equal html on one host) count
once, so that they give no support to their own text.  Vectors are never gathered: a
vector is represented by its number of pages and sums of hashes of (digest of the
page, count), which are added up before and after the shuffle, so one host may
hold any share of the pages.  A host's template and the classes of a round are
bounded by the mean page: their roles occur on at least ``MIN_SUPPORT`` of its pages.

Defined cases: a null page is empty; a page without text gives the empty
string; a page whose url has no host shares a template with others like it; a
host with fewer than ``MIN_PAGES`` distinct pages has no template;
repeated rows get equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import SLICE_ROWS, arrow_map
from tagstream.llm.urls import host_of
from tagstream.session import materialize

#: A host with fewer pages has no template.
MIN_PAGES = 3
#: Part of a host's pages that a class other than the root must occur on.
MIN_SUPPORT = 0.5
#: Members that a valid class has at least.
MIN_MEMBERS = 3

# Elements whose text is never main text.
BOILERPLATE_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe button select textarea svg menu "
    "dialog object audio video canvas".split())
# Words in class, id or role that mark such elements.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice comment "
    "comments sidebar menu nav navigation navbar breadcrumb breadcrumbs footer header share social related "
    "newsletter subscribe popup modal disqus".split())
MAIN_TAGS = frozenset(["article", "main"])
# Elements whose own marks say nothing about the text in them.
UNMARKED = frozenset(["html", "body", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that give paths their steps.
STRUCTURE = frozenset(
    "html head body title nav header footer aside form main article section div ul ol table h1 h2 h3 h4 h5 h6 "
    "noscript template iframe button select textarea svg menu dialog object audio video canvas".split())
# Elements inside a line of text; all others end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:[^>]*)(?:>|\Z)|([^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+")


def marks_of(name: str, attributes: str) -> str:
    """The letter words of an element's class, id and role (what tells paths
    apart: numbers in them differ by page), and a final ``!`` if a whole class
    token, id or role is a boilerplate word.  A heading's id names its section
    and does not count."""
    words, marked = [], False
    for attribute, value in _ATTRIBUTE.findall(attributes):
        attribute = attribute.lower()
        if attribute in ("class", "id", "role"):
            value = value.strip("\"'").lower()
            words += _WORDS.findall(value)
            if name not in UNMARKED and not (attribute == "id" and name in HEADINGS):
                marked = marked or not BOILERPLATE_WORDS.isdisjoint(value.split())
    return " ".join(words) + ("!" if marked else "")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value): ``open`` and ``close`` with the element's name and
    its marks; ``text`` with the run as it stands."""
    for m in _TOKEN.finditer(page):
        if m[5] is not None:
            yield "text", "", m[5]
        elif m[3]:
            name = m[3].lower()
            if m[2]:
                yield "close", name, ""
            else:
                yield "open", name, marks_of(name, m[4]) if m[4] else ""


def is_boilerplate(name: str, marks: str) -> bool:
    return name in BOILERPLATE_TAGS or marks.endswith("!")


class Path:
    """Stack of the structural elements that are open, each with its number."""

    def __init__(self):
        self.stack: list[tuple[str, str, int]] = []

    def open(self, name: str, marks: str, number: int = 0) -> None:
        if name in STRUCTURE:
            self.stack.append((name, marks, number))

    def close(self, name: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                del self.stack[k:]
                return


class Steps(Path):
    """A path that knows the digest of its steps."""

    def __init__(self):
        super().__init__()
        self.digests = ["0"]

    def open(self, name: str, marks: str, number: int = 0) -> None:
        super().open(name, marks, number)
        if len(self.stack) == len(self.digests):
            self.digests.append(xxhash.xxh3_64_hexdigest(f"{self.digests[-1]}/{name}.{marks}"))

    def close(self, name: str) -> None:
        super().close(name)
        del self.digests[len(self.stack) + 1:]

    def digest(self) -> str:
        return self.digests[-1]


def roles(page: str) -> Iterator[tuple[str, str, str, str, str]]:
    """(role, kind, name, marks, run) of every token: the role is what tells
    tokens apart, a tag with its path or a text run."""
    path = Steps()
    for kind, name, value in tokens(page):
        if kind == "text":
            run = " ".join(value.split())
            if run:
                yield "#" + run, kind, "", "", value
            else:
                yield "", kind, "", "", value
            continue
        if kind == "close":
            role = f"{path.digest()}</{name}>" if name in STRUCTURE else f"</{name}>"
            path.close(name)
        else:
            path.open(name, value)
            role = f"{path.digest()}<{name}>"
        yield role, kind, name, value, ""


# ------------------------------------------------------------ templates ----

def token_of(role: str) -> int:
    return xxhash.xxh3_64_intdigest(role) >> 1 or 1


class Template:
    """What is known of a host's template: a tree of classes.

    Class 0 is the page itself and becomes the root.  A class has the gap it
    lies in, its vector, and its members in order, each a (slot, token).  The
    gap after a member is named by the member's slot, the one at a page's begin 0.
    ``often`` are the tokens with enough support (none: not known yet)."""

    def __init__(self, text: str | None = None):
        known = json.loads(text) if text else {"often": None, "next": 1, "classes": [[0, -1, None, []]]}
        self.next = known["next"]
        self.often = None if known["often"] is None else frozenset(known["often"])
        self.classes = {number: (gap, vector, members) for number, gap, vector, members in known["classes"]}
        self.first = {(gap, members[0][1]): number for number, (gap, _, members) in self.classes.items() if number}
        self.owner = {slot: number for number, (_, _, members) in self.classes.items() for slot, _ in members} | {0: 0}

    def text(self) -> str:
        return json.dumps({"next": self.next, "often": None if self.often is None else sorted(self.often),
                           "classes": [[n, *c] for n, c in sorted(self.classes.items())]}, separators=(",", ":"))

    def parse(self, tokens: list[int]) -> list[tuple[int, int, int, int] | None]:
        """(class, index of the member, gap, visit) of every token; class -1
        for one that fills a slot, None for one without enough support.  The
        visit numbers the times that a page comes to the gap."""
        out, outer, visits = [], [], {0: 1}
        number, at, gap = 0, 0, 0
        members = self.classes[0][2]
        for token in tokens:
            if self.often is not None and token not in self.often:
                out.append(None)
            elif at < len(members) and members[at][1] == token:
                out.append((number, at, gap, 0))
                gap = members[at][0]
                at += 1
                if number and at == len(members):
                    number, at, gap = outer.pop()
                    members = self.classes[number][2]
                else:
                    visits[gap] = visits.get(gap, 0) + 1
            elif (gap, token) in self.first:
                outer.append((number, at, gap))
                number, at = self.first[gap, token], 1
                out.append((number, 0, gap, visits[gap]))
                members = self.classes[number][2]
                gap = members[0][0]
                visits[gap] = visits.get(gap, 0) + 1
            else:
                out.append((-1, 0, gap, visits[gap]))
        return out

    def candidates(self, found: str | None) -> list[tuple[int | None, int, list, list[int]]]:
        """(class that it belongs to or None, gap, vector, tokens in the order of
        one page) of the classes among the slots' tokens, highest rank first."""
        out = []
        for c in json.loads(found or "[]"):
            vector, tokens = [c["pages"], c["h1"], c["h2"]], [m["token"] for m in c["members"]]
            number = self.owner[c["gap"]]
            around = self.classes[number]
            belongs = 0 in tokens if self.often is None else vector == around[1]
            tokens = [t for t in tokens if t]
            if len(tokens) >= (1 if belongs and around[2] else MIN_MEMBERS):
                out.append((number if belongs else None, c["gap"], vector, tokens, c["n"]))
        out.sort(key=lambda c: (c[0] is None, -c[2][0], c[4], -len(c[3]), c[1], c[3]))
        return [c[:4] for c in out]

    def judge(self, candidates: list, where: dict, tokens: list[int]) -> Iterator[tuple[int, int, int]]:
        """What a page says against candidates: (candidate, token, -1) for a
        member out of order or in another gap, (candidate, 0, -1) for one with a
        class of the template between its members, (candidate, 0, other) for
        one that lies in the other (both ways if they cross).  ``where`` has the candidate
        and rank of a (gap, token)."""
        met: dict[int, list[tuple[int, int, int, int]]] = {}
        times: dict[tuple[int, int], int] = {}
        nested: dict[int, list[int]] = {}
        for k, place in enumerate(self.parse(tokens)):
            if place is None:
                continue
            number, at, gap, visit = place
            if number >= 0:
                if number and not at:
                    nested.setdefault(gap, []).append(k)
            elif (hit := where.get((gap, tokens[k]))) is not None:
                j = times[hit] = times.get(hit, -1) + 1
                met.setdefault(hit[0], []).append((j, hit[1], k, visit))
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for c, seen in met.items():
            belongs, gap, _, members = candidates[c]
            order = [j * len(members) + rank for j, rank, _, _ in seen]
            bad = {order[k] % len(members) for k in out_of_order(order)}
            visits = {j: visit for j, rank, _, visit in seen if not rank}
            bad |= {rank for j, rank, _, visit in seen if visit != (j + 1 if belongs is not None else visits.get(j))}
            for rank in bad:
                yield c, members[rank], -1
            if belongs is None:
                ends: dict[int, tuple[int, int]] = {}
                for j, _, k, _ in seen:
                    ends[j] = ends[j][0] if j in ends else k, k
                spans.setdefault(gap, []).extend((a, b, c) for a, b in ends.values())
        for gap, found in spans.items():
            found.sort()
            inner, open_until = nested.get(gap, []), {}
            for a, b, c in found:
                if bisect.bisect(inner, a) < bisect.bisect(inner, b):
                    yield c, 0, -1
                for other, end in open_until.items():
                    if end > a and other != c:
                        yield c, 0, other
                        if b > end:
                            yield other, 0, c
                open_until[c] = max(b, open_until.get(c, b))

    def grow(self, found: str | None, against: list[dict]) -> bool:
        """Take the classes that all pages allow; is there any?"""
        candidates = self.candidates(found)
        bad = {(a["candidate"], a["token"]) for a in against if a["token"]}
        inside = {(a["candidate"], a["other"]) for a in against if not a["token"]}
        if self.often is None:
            self.often = frozenset(m["token"] for c in json.loads(found or "[]") for m in c["members"])
            whole = next(([c["pages"], c["h1"], c["h2"]] for c in json.loads(found or "[]")
                          if any(m["token"] == 0 for m in c["members"])), None)
            self.classes[0] = -1, whole, []
        grown: set[int] = set()
        fit: dict[int, dict[int, list[int]]] = {}  # by gap: members of the classes that may be taken
        for c, (number, gap, vector, tokens) in enumerate(candidates):
            members = [t for t in tokens if (c, t) not in bad]
            around = self.classes[self.owner[gap]][2]
            if len(members) < (1 if number is not None and around else MIN_MEMBERS):
                continue
            if number is not None:
                at = 1 + next((k for k, (slot, _) in enumerate(around) if slot == gap), -1)
                around[at:at] = [[self.next + k, t] for k, t in enumerate(members)]
                self.next += len(members)
                grown.add(gap)
            elif (c, -1) not in inside and gap not in grown:
                fit.setdefault(gap, {})[c] = members
        for gap, some in fit.items():
            taken: list[int] = []
            for c in some:
                if not any((c, o) in inside and ((o, c) not in inside or o in taken) for o in some):
                    taken.append(c)
            for c in taken or [*some][:1]:
                self.classes[self.next] = gap, candidates[c][2], [[self.next + k, t] for k, t in enumerate(some[c])]
                self.next += len(some[c])
        lost = set(grown)  # a gap that is cut anew is filled anew
        while lost:
            gone = [n for n, (gap, _, _) in self.classes.items() if gap in lost]
            lost = {slot for n in gone for slot, _ in self.classes.pop(n)[2]}
        return bool(grown or fit)


def out_of_order(values: list[int]) -> list[int]:
    """Positions that a longest rising subsequence leaves out."""
    if all(a < b for a, b in zip(values, values[1:])):
        return []
    tails, last, before = [], [], []
    for k, v in enumerate(values):
        at = bisect.bisect_left(tails, v)
        before.append(last[at - 1] if at else -1)
        tails[at:at + 1], last[at:at + 1] = [v], [k]
    kept, k = set(), last[-1]
    while k >= 0:
        kept.add(k)
        k = before[k]
    return [k for k in range(len(values)) if k not in kept]


class Known:
    """Makes something of a text once for the last texts seen by a task."""

    def __init__(self, make=Template, most: int = 256):
        self.make, self.most, self.made = make, most, {}

    def __call__(self, *texts):
        if texts not in self.made:
            if len(self.made) >= self.most:
                self.made.clear()
            self.made[texts] = self.make(*texts)
        return self.made[texts]


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, digest, tokens of every distinct page of a host."""

    def make():
        def fn(batch):
            html_ = batch.column(1).to_pylist()
            digests = [hashlib.sha256(page.encode("utf-8", "surrogatepass")).digest()[:16] for page in html_]
            found = [[token_of(role) for role, *_ in roles(page) if role] for page in html_]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()),
                                               pa.array(found, pa.list_(pa.int64()))], names=["host", "digest", "tokens"])
        return fn

    return arrow_map(pages.select("host", "html"), "host string, digest binary, tokens array<long>",
                     make).dropDuplicates(["host", "digest"])


_PARTIAL = pa.schema([(name, pa.string() if name == "host" else pa.int64()) for name in
                      "host gap token pages h1 h2 n page at".split()])
#: Sums that a task holds before it passes them on.
_MOST_SUMS = 50_000


def token_sums(pages: DataFrame) -> DataFrame:
    """Per host, gap and token that fills a slot: pages it occurs on, sums that
    stand for its occurrence vector, occurrences, and its first position on
    the page of the least digest.  Token 0 stands for the page itself."""

    def run(batches):
        known, sums = Known(), {}

        def done():
            rows = [(*key, *s) for key, s in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTIAL)], schema=_PARTIAL)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for host, digest, tokens, text in zip(*(c.to_pylist() for c in part.columns)):
                    seen: dict[tuple[int, int], list[int]] = {(0, 0): [1, -1]}
                    for k, (token, place) in enumerate(zip(tokens, known(text).parse(tokens))):
                        if place and place[0] < 0:
                            seen.setdefault((place[2], token), [0, k])[0] += 1
                    page = int.from_bytes(digest[:8]) >> 1
                    vectors: dict[int, int] = {}
                    for (gap, token), (n, first) in seen.items():
                        if n not in vectors:
                            vectors[n] = xxhash.xxh3_64_intdigest(digest + b":%d" % n)
                        s = sums.setdefault((host, gap, token), [0, 0, 0, 0, page, first])
                        s[0] += 1
                        s[1] += vectors[n] >> 33
                        s[2] += vectors[n] & 0x7FFFFFFF
                        s[3] += n
                        if page < s[4]:
                            s[4:] = page, first
                if len(sums) > _MOST_SUMS:
                    yield done()
        if sums:
            yield done()

    parts = pages.select("host", "digest", "tokens", "template").mapInArrow(
        run, "host string, gap long, token long, pages long, h1 long, h2 long, n long, page long, at long")
    return parts.groupBy("host", "gap", "token").agg(
        F.sum("pages").alias("pages"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"), F.sum("n").alias("n"),
        F.min(F.struct("page", "at"))["at"].alias("at"))


def objections(pages: DataFrame) -> DataFrame:
    """Per host: what its pages say against the classes found in a round."""

    def prepared(text, found):
        template = Template(text)
        candidates = template.candidates(found)
        return template, candidates, {(gap, t): (c, rank) for c, (_, gap, _, tokens) in enumerate(candidates)
                                      for rank, t in enumerate(tokens)}

    def run(batches):
        known = Known(prepared)
        for batch in batches:
            said = set()
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for host, tokens, text, found in zip(*(c.to_pylist() for c in part.columns)):
                    template, candidates, where = known(text, found)
                    if candidates:
                        said.update((host, *a) for a in template.judge(candidates, where, tokens))
            if said:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*said), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["host", "candidate", "token", "other"])

    said = pages.select("host", "tokens", "template", "found").where("found is not null").mapInArrow(
        run, "host string, candidate long, token long, other long").distinct()
    return said.groupBy("host").agg(F.collect_list(F.struct("candidate", "token", "other")).alias("against"))


def templates(pages: DataFrame) -> DataFrame:
    """host, template (as text) of the hosts with enough pages."""
    pages = materialize(page_tokens(pages), "html-pages")
    hosts, done = None, []
    while True:
        if hosts is None:
            sums = materialize(token_sums(pages.withColumn("template", F.lit(""))), "html-tokens")
            hosts = materialize(sums.where("token = 0").where(F.col("pages") >= MIN_PAGES).select(
                "host", F.col("pages").alias("all"), F.lit("").alias("template")), "html-hosts")
        else:
            sums = token_sums(pages.join(hosts, "host"))
        often = sums.join(hosts.select("host", "all"), "host").where(F.col("pages") >= MIN_SUPPORT * F.col("all"))
        classes = often.groupBy("host", "gap", "pages", "h1", "h2").agg(
            F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "token"))).alias("members"))
        found = classes.groupBy("host").agg(F.to_json(F.collect_list(
            F.struct("gap", "pages", "h1", "h2", "n", "members"))).alias("found"))
        found = materialize(hosts.join(found, "host", "left"), "html-classes")

        def make():
            def fn(batch):
                rows = [(host, n, template := Template(text), template.grow(found, against or [])) for
                        host, n, text, found, against in zip(*(c.to_pylist() for c in batch.columns))]
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2].text() for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.bool_())],
                    names=["host", "all", "template", "grown"])
            return fn

        against = objections(pages.join(found, "host"))
        grown = materialize(arrow_map(found.join(against, "host", "left").select(
            "host", "all", "template", "found", "against"), "host string, all long, template string, grown boolean",
            make), "html-templates")
        done.append(grown.where("not grown").select("host", "template"))
        hosts = grown.where("grown").drop("grown")
        if hosts.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)


# ----------------------------------------------------------- extraction ----

Stack = list[tuple[str, str, int]]


def _wanted(stack: Stack, within_main: bool, exempt: set[int]) -> bool:
    """Is text under these elements main text?  Marks on the main element and
    those around it (``exempt``) do not count, nor does a form around it."""
    if within_main and not any(name in MAIN_TAGS for name, _, _ in stack):
        return False
    return not any(is_boilerplate(name, marks) and not (number in exempt and (
        name == "form" or name not in BOILERPLATE_TAGS)) for name, marks, number in stack)


def around_main(walk: Iterator[tuple[str, str, Stack]]) -> set[int]:
    """Numbers of the page's main element, the elements around it, and the
    main elements beside it.  The main element is the first article that does
    not lie in a boilerplate element (a form aside), or else the first main."""
    found: dict[str, tuple[set[int], int | None]] = {}
    for kind, name, stack in walk:
        if kind != "open" or name not in MAIN_TAGS or not stack or stack[-1][0] != name or any(
                n in BOILERPLATE_TAGS and n != "form" for n, _, _ in stack):
            continue
        parent = stack[-2][2] if len(stack) > 1 else None
        if name not in found:
            found[name] = {number for _, _, number in stack}, parent
        elif found[name][1] == parent:
            found[name][0].add(stack[-1][2])
    return found.get("article", found.get("main", (set(), None)))[0]


def extract(page: str, template: Template | None = None) -> str:
    """Main text of a page under its host's template."""
    seen = list(roles(page))
    places = [None] * len(seen)
    if template:
        at = [k for k, (role, *_) in enumerate(seen) if role]
        for k, place in zip(at, template.parse([token_of(seen[k][0]) for k in at])):
            places[k] = place if place and place[0] >= 0 else None
    within_main = any(kind == "open" and name in MAIN_TAGS for _, kind, name, _, _ in seen)
    blocks: list[str] = []
    block: list[str] = []
    own = False  # does the block hold more than the template's text?

    def walk():
        """Each token with the elements open after it.  At the root's tags these
        are the elements that the template has open there."""
        path, root = Path(), Path()
        for k, (role, kind, name, marks, run) in enumerate(seen):
            if kind == "text":
                pass
            elif places[k] and places[k][0] == 0 and (kind == "open" or name in STRUCTURE):
                if kind == "open":
                    root.open(name, marks, -1 - k)
                else:
                    root.close(name)
                path.stack = list(root.stack)
            elif kind == "open":
                path.open(name, marks, k)
            else:
                path.close(name)
            yield k, kind, name, run, path.stack

    exempt = around_main((kind, name, stack) for _, kind, name, _, stack in walk()) if within_main else set()

    def end():
        if block:
            run = " ".join(html.unescape("".join(block)).split())
            if run and own:
                blocks.append(run)
            block.clear()

    for k, kind, name, run, stack in walk():
        if kind == "text":
            if _wanted(stack, within_main, exempt):
                block.append(run)
                own = own or within_main or (bool(seen[k][0]) and places[k] is None)
            continue
        if name not in INLINE:
            end()
            own = False
    end()
    return " ".join(blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", F.col("url"), host_of(F.col("url").cast("string")).alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.join(templates(rows.select("host", "html")), "host", "left").select("page_id", "url", "html", "template")
    id_type = rows.schema["page_id"].dataType.simpleString()

    def make():
        known = Known()

        def fn(batch):
            out = [extract(page, known(text) if text else None) for page, text in
                   zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        return fn

    return arrow_map(rows, f"page_id {id_type}, url string, text string, n_chars long", make)
