"""URL rules with redirect equivalence, in DataFrame operations.

Each url is judged by the longest rule (host and path) that fits.  Pages that
redirect to one another or name a canonical address are aliases: connected
components over those links carry block decisions to members that no rule
fits.  Allow takes precedence: a url with a rule of its own keeps it, and in a
component that holds an allowed url, members without a rule are allowed.

Only urls and links are shuffled, never a page.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule, has no aliases and is allowed; a null page has no links; equal
urls (after lower-casing the host, dropping the fragment, removing dot segments
and reading an empty path as ``/``) are one vertex; relative links are resolved
against the page's ``<base>`` or else its url; links of schemes without ``//``
(``mailto:``) are none;
links to urls outside the table still join components; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.llm.components import components
from tagstream.session import materialize

#: (verdict, host, path) in the order of the contract.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*(/?[^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null.  A few
    rules: a chain of conditions, longest first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def without_dots(path: Column) -> Column:
    """The path without its ``.`` and ``..`` segments; an empty one is ``/``."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(
            x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    whole = F.concat(F.lit("/"), F.array_join(kept, "/"),
                     F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(path == "", "/").when(path.rlike(r"/\.\.?(/|$)"), whole).otherwise(path)


def vertex_of(url: Column) -> Column:
    """The url without its fragment and dot segments, host in lower case, at
    least ``/`` as its path; null without ://."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^(?s:.*?)://", 0))
    return F.when(F.instr(bare, "://") > 0, F.concat(
        scheme, host_of(bare), without_dots(path_of(bare)),
        F.regexp_replace(bare, r"^(?s:.*?)://[^?]*", "")))


def resolve(target: Column, base: Column) -> Column:
    """The absolute url of a link on a page with url ``base``; null without a
    target or where it has a scheme but no ``//``."""
    origin = F.regexp_extract(base, r"^(?s:.*?)://[^/?#]*", 0)
    path = path_of(base)
    folder = F.regexp_extract(path, r"^(?s:.*/)", 0)
    return (F.when(target == "", None)
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target)
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
            .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^(?s:.*?:)(?=//)", 0), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(origin, path, target))
            .when(target.startswith("#"), base)
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target)))


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(value, "^[\"']|[\"']$", ""), "&amp;", "&"))


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): vertices of a page and of its canonical or redirect target.
    Relative targets are resolved against the page's base."""
    html = F.coalesce("html", F.lit(""))
    tags = F.regexp_extract_all(html, F.lit(
        r"(?is)(<(?:link|meta)\b[^>]*\b(?:canonical|refresh)\b[^>]*>)"), 1)
    base = F.regexp_extract(html, r"(?is)<base\b[^>]*\shref\b[^>]*>", 0).alias("base")
    t = materialize(pages.select(F.col("url").cast("string").alias("url"), base, F.explode(tags).alias("tag")),
                    "link-tags")
    canonical = F.when(F.lower(_attribute(F.col("tag"), "rel")) == "canonical", _attribute(F.col("tag"), "href"))
    refresh = F.when(F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh", F.regexp_extract(
        _attribute(F.col("tag"), "content"), r"(?i)url\s*=\s*['\"]?([^'\"\s]+)", 1))
    t = materialize(t.where(F.instr("url", "://") > 0).select(
        "url", F.coalesce(canonical, refresh).alias("to"), _attribute(F.col("base"), "href").alias("base")),
        "link-targets")
    t = materialize(t.select("url", "to", F.coalesce(resolve(F.col("base"), F.col("url")), "url").alias("base")),
                    "link-bases")
    t = materialize(t.select("url", resolve(F.col("to"), F.col("base")).alias("to")), "link-ends")
    return t.select(vertex_of(F.col("url")).alias("a"), vertex_of(F.col("to")).alias("b"))


def judge(pages: DataFrame, rules=RULES, links: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, alias_group.

    ``links`` (columns a, b: urls) adds a redirect log to the links that the
    pages themselves hold."""
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    name, own = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), vertex_of(url).alias("vertex"))
    rows = rows.withColumn("rule", name).withColumn("own", own)
    edges = page_links(pages)
    if links is not None:
        edges = edges.unionByName(links.select(vertex_of(F.col("a")).alias("a"), vertex_of(F.col("b")).alias("b")))
    # a linked url counts by its own rule even if it has no page in the table
    label = components(edges)
    known = materialize(label.select("vertex", "component", host_of(F.col("vertex")).alias("host"),
                                     path_of(F.col("vertex")).alias("path")), "alias-groups").withColumn("own", own)
    passed = known.groupBy("component").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    carried = F.when(F.coalesce("allowed", F.lit(False)), "allow").when(
        F.coalesce("blocked", F.lit(False)), "block").otherwise("allow").alias("carried")
    alias = known.join(passed, "component").select("vertex", "component", carried)
    out = rows.join(alias, "vertex", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("own", "carried", F.lit("allow")).alias("verdict"),
                      F.col("component").alias("alias_group"))
