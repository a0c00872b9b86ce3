import html
import re

import __spark_entry__ as E
from tagstream.llm import html_text as H
from tests.llm.helpers import SF, table


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")


def test_query_gives_the_articles(spark):
    got = {r["page_id"]: r for r in E.queries()["op4_html_text"](spark, SF).collect()}
    pages = table("pages")
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p|br)>", body)]
        want = " ".join(x for x in parts if x)
        assert got[p["page_id"]]["text"] == want
        assert got[p["page_id"]]["n_chars"] == len(want) and got[p["page_id"]]["url"] == p["url"]


def page(k, body):
    return (f"<html><head><title>t{k}</title><style>p{{}}</style></head><body><div class='top nav'><ul><li>Home<li>News</ul>"
            f"</div><div id=content>{body}</div><div>Copyright by us</div><form>Search <input></form>"
            f"<script>var x = '</p>{k}';</script></body></html>")


def test_template_text_and_boilerplate_go_without_an_article(spark):
    rows = [(k, "http://h.org/%d" % k, page(k, f"<h2>Title {k}</h2><p>Body <i>of</i>{k}&amp;co.<br>Next &#233; line {k}"))
            for k in range(6)]
    got = {r["page_id"]: r["text"] for r in H.main_text(frame(spark, rows)).collect()}
    assert got == {k: f"Title {k} Body of{k}&co. Next é line {k}" for k in range(6)}


def test_article_on_pages_with_menus_notices_and_comments():
    text = ("<body><header>Top</header><main><article><h1>A &lt;b&gt;</h1><p>x<!-- no --> y<p>z <b>w</b>!"
            "<aside>side</aside><div class='comments'>reader</div><div class=ad>buy</div></article></main>"
            "<p>outside</p><footer>f</footer>")
    assert H.extract(text) == "A <b> x y z w!"
    assert H.extract("") == "" and H.extract("plain  text\n here") == "plain text here"
    assert H.extract("<article>cut <b>off") == "cut off"


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://h/1", "<article>a</article>"), (3, "http://h/1", "<nav>n</nav>"),
            (3, "http://h/1", "<nav>n</nav>"), (4, "x", "<article>" + "word <b>" * 20000)]
    got = [(r["page_id"], r["text"][:9]) for r in H.main_text(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (2, ""), (None, "a"), (3, ""), (3, ""), (4, "word word")], key=str)
    assert H.main_text(frame(spark, [])).count() == 0


def test_marks_around_the_article_do_not_count(spark):
    for page in ('<body class="sidebar has-sidebar"><div class="content with-sidebar"><article>A b</article></div>',
                 '<body><div class="content sidebar"><main class=share><article class="post share">A b</article></main></div>',
                 '<body><form id=f class=social><article data-role="ad" data-id=nav title="class=ad">A b</article></form>',
                 '<main><article>A<h2 id="related">b</h2></article></main>', '<main role=banner>A b</main>',
                 '<div><article class="share">A</article><article class="share">b</article></div>',
                 '<body class="menu"><div class="with-sidebar related-work" data-role=menu>A b</div>'):
        assert H.extract(page) == "A b", page
        rows = [(k, "http://h.org/%d" % k, page.replace("b<", f"b{k}<")) for k in range(4)]
        assert {r["text"] for r in H.main_text(frame(spark, rows)).collect()} == {f"A b{k}" for k in range(4)}, page


def test_marks_below_and_beside_the_article_count():
    assert H.extract('<main><article class=share>A<div id=comments><article class=x>c</article></div>'
                     '<article class=comment>d</article><section role=Navigation>e</section></article>'
                     '<div class="x related"><article>f</article></div></main><aside><article>g</article></aside>') == "A"
    assert H.extract("<body><aside><article class=ad>g</article></aside><div class=top><article class=post>A</article>") == "A"


def test_copies_give_no_support_to_their_own_text(spark):
    own = "".join(f"<h2>Part {k}</h2><p>Line {k} of the copied page" for k in range(4))
    rows = [(k, "http://h.org/%d" % k, page(0, own)) for k in range(9)]
    rows += [(k, "http://h.org/%d" % k, page(k, f"<h2>Title {k}</h2><p>Body of {k}<br>Next line {k}")) for k in range(9, 13)]
    got = {r["page_id"]: r["text"] for r in H.main_text(frame(spark, rows)).collect()}
    copied = " ".join(f"Part {k} Line {k} of the copied page" for k in range(4))
    assert got == {k: copied if k < 9 else f"Title {k} Body of {k} Next line {k}" for k in range(13)}
    alone = [r["text"] for r in H.main_text(frame(spark, [(1, "http://h.org/1", f"<p>{own}")] * 5)).collect()]
    assert alone == [copied] * 5


def found(spark, bodies):
    """The template of one host's pages, and the pages' tokens."""
    rows = [("h", f"<html><head><title>t{k}</title></head><body>{b}</body></html>") for k, b in enumerate(bodies)]
    (row,) = H.templates(spark.createDataFrame(rows, "host string, html string")).collect()
    return H.Template(row["template"]), [[H.token_of(r[0]) for r in H.roles(html) if r[0]] for _, html in rows]


def test_a_run_has_another_role_in_another_gap(spark):
    """Menu words that also occur in some texts: their vectors are those of the
    root only once the root's gaps part the roles."""
    def body(k):
        said = ["", "<p>Home", "<p>Home<p>News<p>Home", "<p>Contact"][k % 4]
        return f"<h2>Title {k}</h2><p>Body {k}{said}"
    rows = [(k, "http://h.org/%d" % k, page(k, body(k)).replace("top nav", "top").replace("<li>News", "<li>News<li>Contact"))
            for k in range(8)]
    got = {r["page_id"]: r["text"] for r in H.main_text(frame(spark, rows)).collect()}
    assert got == {k: f"Title {k} Body {k}" + ["", " Home", " Home News Home", " Contact"][k % 4] for k in range(8)}


def test_classes_nest_in_gaps(spark):
    """Cards of a list, on some pages with a badge of three tokens inside."""
    plain, badged = "<li><i>by</i> a{0}</li>", "<li><i>by</i> a{0}<b><s>new</s></b></li>"
    bodies = ["<ul>" + "".join((badged if (k + j) % 3 else plain).format(f"{k}.{j}") for j in range(2 + k % 3))
              + f"</ul><p>by<p>x{k}" for k in range(9)]
    template, pages = found(spark, bodies)
    gap_of = {n: gap for n, (gap, _, _) in template.classes.items() if n}
    cards = [n for n, gap in gap_of.items() if template.owner[gap] == 0]
    badges = [n for n, gap in gap_of.items() if template.owner[gap] in cards]
    assert len(template.classes) == 3 and len(cards) == len(badges) == 1
    by = H.token_of("#by")
    for k, tokens in enumerate(pages):
        places = template.parse(tokens)
        assert sum(p == (cards[0], 0, gap_of[cards[0]], 1) for p in places if p) == 2 + k % 3
        assert sum(p[:2] == (badges[0], 0) for p in places if p) == sum((k + j) % 3 > 0 for j in range(2 + k % 3))
        assert [p[0] for p, t in zip(places, tokens) if t == by] == [cards[0]] * (2 + k % 3) + [0]


def test_boxes_in_two_orders_do_not_stay_one_class(spark):
    one, two = "<p><i>Follow</i></p>", "<p><s>Weather</s></p>"
    bodies = [f"<div>{one}{two}</div><p>x{k}" if k % 2 else f"<div>{two}{one}</div><p>x{k}" for k in range(8)]
    template, pages = found(spark, bodies)
    root = [t for _, t in template.classes[0][2]]
    words = {H.token_of("#Follow"), H.token_of("#Weather")}
    assert len(words.intersection(root)) == 1
    for tokens in pages:
        assert [k for c, k, *_ in filter(None, template.parse(tokens)) if c == 0] == list(range(len(root)))


def test_a_class_is_held_against_every_page():
    template = H.Template()
    assert H.out_of_order([0, 1, 2, 3]) == [] and H.out_of_order([0, 3, 1, 2]) == [1]
    rows = [{"gap": 0, "pages": 4, "h1": 1, "h2": 1, "n": 4, "members": [{"at": k - 1, "token": k} for k in range(5)]},
            {"gap": 0, "pages": 4, "h1": 2, "h2": 2, "n": 8, "members": [{"at": k, "token": k} for k in (7, 8, 9)]}]
    found = H.json.dumps(rows)
    candidates = template.candidates(found)
    assert [c[3] for c in candidates] == [[1, 2, 3, 4], [7, 8, 9]]
    where = {(0, t): (c, r) for c, x in enumerate(candidates) for r, t in enumerate(x[3])}
    assert not list(template.judge(candidates, where, [1, 2, 7, 8, 9, 7, 8, 9, 3, 4]))
    said = [*template.judge(candidates, where, [1, 4, 2, 3, 7, 8, 7, 9, 8, 9])]
    assert said == [(0, 4, -1), (1, 9, -1)] or {s[0] for s in said} == {0, 1}
    assert template.grow(found, [dict(zip(("candidate", "token", "other"), s)) for s in said])
    assert [t for _, t in template.classes[0][2]] == [1, 2, 3] and template.often == {0, 1, 2, 3, 4, 7, 8, 9}
