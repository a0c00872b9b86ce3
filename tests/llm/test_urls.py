from urllib.parse import urljoin

import __spark_entry__ as E
from tagstream.llm import urls
from tests.llm.helpers import SF, table

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def cut(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return host, rest[:end]


def rule(url):
    host, path = cut(url)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "page_id long, url string, html string, host string, verdict string")


def test_query_equals_brute_force(spark):
    got = {r["page_id"]: r for r in E.queries()["op2_url_filter"](spark, SF).collect()}
    pages = table("pages")
    assert len(got) == len(pages)
    for p in pages:
        r, (name, verdict) = got[p["page_id"]], rule(p["url"])
        assert (r["host"], r["path"], r["rule"]) == (*cut(p["url"]), name)
        assert r["verdict"] == (verdict or "allow")


def canonical(url):
    return f'<html><head><LINK href="{url}" rel=canonical></head></html>'


def refresh(url):
    return f"<meta http-equiv='Refresh' content='0; URL={url}'>"


def test_aliases_carry_block_and_allow_takes_precedence(spark):
    rows = [
        (1, "http://a.example.net/es/1", canonical("http://b.example.org/x")),      # blocked by its rule
        (2, "http://b.example.org/x#top", "plain"),                                 # alias of 1
        (3, "http://c.example.org/y", refresh("http://B.example.org/x")),           # alias by redirect
        (4, "https://z.example.com/de/1", canonical("http://b.example.org/x2")),    # allowed by its rule
        (5, "http://b.example.org/x2", canonical("//d.example.org/q?a=1&amp;b=2")),  # alias of an allowed url
        (6, "http://d.example.org/q?a=1&b=2", canonical("http://e.example.net/fr/")),  # group with allow and block
        (7, "http://e.example.net/fr/", None),                                      # keeps its own rule
        (8, "http://f.example.org/p", canonical("/es/other")),                      # relative target
        (9, None, canonical("http://a.example.net/es/1")), (10, "no scheme", "x"), (11, "http://g.org", ""),
        (2, "http://b.example.org/x#top", "plain"),
    ]
    got = [(r["page_id"], r["verdict"]) for r in urls.judge(frame(spark, rows)).collect()]
    assert sorted(got) == sorted([(1, "block"), (2, "block"), (2, "block"), (3, "block"), (4, "allow"), (5, "allow"),
                                  (6, "allow"), (7, "block"), (8, "allow"), (9, "allow"), (10, "allow"), (11, "allow")])
    log = spark.createDataFrame([("http://g.org", "http://a.example.net/es/1"), (None, "http://g.org")],
                                "a string, b string")
    with_log = {r["page_id"]: r["verdict"] for r in urls.judge(frame(spark, rows), links=log).collect()}
    assert with_log[11] == "block" and with_log[8] == "allow"


def test_hosts_and_paths(spark):
    odd = ["HTTP://WWW.Example.COM/en/A?x#y", "http://example.com", "http://example.com?/en/", "http://xexample.com/en/",
           "://h/p", "a://b://c/d", "http:///p", "", "ÀÉ://ÀÉ.com/x", "http://example.com/en/", "http://u@EXAMPLE.com:80/en/"]
    rows = [(k, u, None) for k, u in enumerate(odd)]
    got = {r["page_id"]: r for r in urls.judge(frame(spark, rows)).collect()}
    for k, u in enumerate(odd):
        assert (got[k]["host"], got[k]["path"]) == cut(u), u
        assert got[k]["rule"] == rule(u)[0]


def test_empty_table(spark):
    assert urls.judge(frame(spark, [])).count() == 0


def test_relative_links_are_resolved(spark):
    base = "http://a.example.net/x/y/page.html?q=/../1#f"
    targets = ["page2.html", "../z", "?p=2", "./", ".", "..", "../../../es/1", "q/./r/../s?u=/a/../b", "//h.org", "//h.org?x",
               "/a/../b/.", "/login?u=http://z.org/", "go?u=http://z.org/..", "http://o.org", "#top",
               "...", "a..b/.c"]
    rows = [(base, canonical(f"{t}")) for t in targets] + [(base, refresh(t)) for t in targets]
    got = {(r["a"], r["b"]) for r in urls.page_links(spark.createDataFrame(rows, "url string, html string")).collect()}

    def bare(url):
        head, mark, query = url.split("#")[0].partition("?")
        return head + "/" * (head.count("/") == 2) + mark + query
    want = {(bare(base), bare(urljoin(base, t))) for t in targets}
    assert got == want
    odd = [(base, canonical("http://o.org/a/./b/../c")), (base, canonical("mailto:x@y")), (base, "<link rel=canonical>"), ("http://h", canonical("p")), (None, canonical("p")),
           (base, "<base href='/en/'>" + canonical("p?x")), ("http://h?q", canonical("../.."))]
    got = urls.page_links(spark.createDataFrame(odd, "url string, html string")).collect()
    assert {(r["a"], r["b"]) for r in got if r["b"]} == {
        (bare(base), "http://o.org/a/c"), ("http://h/", "http://h/p"), (bare(base), "http://a.example.net/en/p?x"), ("http://h/?q", "http://h/")}


def test_relative_links_carry_block(spark):
    rows = [(1, "http://f.example.net/de/p", refresh("../es/other")), (2, "http://g.org", canonical("http://f.example.net/fr/1")),
            (3, "http://k.org/a", canonical("HTTP://G.org/")), (4, "http://k.org/b", canonical("x/../../a")),
            (5, "http://k.org/c/d", canonical("e"))]
    assert {r["page_id"]: r["verdict"] for r in urls.judge(frame(spark, rows)).collect()} == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}
