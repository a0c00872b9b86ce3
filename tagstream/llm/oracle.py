"""DuckDB SQL of the queries that SQL can express.

op2's SQL judges by the rules alone: the given pages hold no canonical or
redirect link, so no alias carries a decision there (tests hold the links
against a brute-force version).
"""

from __future__ import annotations

from tagstream.llm.urls import RULES

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rule(result: str) -> str:
    """The longest rule that fits: its name, or its verdict."""
    cases = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN "
             + (f"'{h + p}'" if result == "name" else f"'{v}'")
             for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return f"CASE {' '.join(cases)} END"


ORACLE["op2_url_filter"] = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*(/?[^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, {_rule("name")} AS rule, coalesce({_rule("verdict")}, 'allow') AS verdict,
       CAST(NULL AS VARCHAR) AS alias_group
FROM h"""

ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d
           FROM pages),
g AS (SELECT d, max(page_id) AS response FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN response <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> p.page_id THEN response END AS refers_to, url
FROM p LEFT JOIN g ON p.d = g.d AND p.n >= 1000"""

ORACLE["op11_phrases"] = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                 '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM pieces),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
f1 AS (SELECT lang, ph, count(*) AS a FROM (SELECT lang, unnest(ws) AS ph FROM w) GROUP BY ALL HAVING count(*) >= 10),
f2 AS (SELECT lang, w1, w2, count(*) AS a FROM (
         SELECT lang, unnest(ws[:-2]) AS w1, unnest(ws[2:]) AS w2 FROM w WHERE len(ws) >= 2)
       GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM (
         SELECT lang, unnest(ws[:-3]) AS w1, unnest(ws[2:-2]) AS w2, unnest(ws[3:]) AS w3 FROM w WHERE len(ws) >= 3)
       GROUP BY ALL HAVING count(*) >= 10),
two AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, l.a AS l, r.a AS r,
               (1000000::HUGEINT * f2.a * f2.a) // (l.a::HUGEINT * r.a) AS score
        FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.ph = f2.w1 JOIN f1 r ON r.lang = f2.lang AND r.ph = f2.w2
        WHERE NOT EXISTS (SELECT 1 FROM f3 c WHERE c.lang = f2.lang AND c.w1 = f2.w1 AND c.w2 = f2.w2 AND 100 * c.a >= 50 * f2.a)
          AND NOT EXISTS (SELECT 1 FROM f3 c WHERE c.lang = f2.lang AND c.w2 = f2.w1 AND c.w3 = f2.w2 AND 100 * c.a >= 50 * f2.a)),
cuts AS (SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.a, b1.a AS l1, b23.a AS r1, b12.a AS l2, b3.a AS r2,
                (1000000::HUGEINT * f3.a * f3.a) // (b1.a::HUGEINT * b23.a) AS s1,
                (1000000::HUGEINT * f3.a * f3.a) // (b12.a::HUGEINT * b3.a) AS s2
         FROM f3 JOIN f1 b1 ON b1.lang = f3.lang AND b1.ph = f3.w1 JOIN f1 b3 ON b3.lang = f3.lang AND b3.ph = f3.w3
         JOIN f2 b12 ON b12.lang = f3.lang AND b12.w1 = f3.w1 AND b12.w2 = f3.w2
         JOIN f2 b23 ON b23.lang = f3.lang AND b23.w1 = f3.w2 AND b23.w2 = f3.w3),
every AS (SELECT * FROM two UNION ALL
          SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
          FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE["op13_repeats"] = """
WITH w AS (SELECT doc_id, row_number() OVER () AS rid,
                  list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws
           FROM documents),
starts AS (SELECT rid, s, array_to_string(ws[s:s + 34], ' ') AS win
           FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS s FROM w WHERE len(ws) >= 35)),
twice AS (SELECT win FROM starts GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, s + k AS i FROM starts JOIN twice USING (win), range(35) t(k)),
words AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)"""
