"""DuckDB SQL of the queries that SQL can express, and values both sides share."""

HOST_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def _cases(result: str) -> str:
    out = []
    for verdict, host, path in sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2])):
        value = verdict if result == "verdict" else host + path
        out.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{value}'")
    return " ".join(out)


_TWO = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "co.in", "co.za")
_LAST_TWO = "regexp_extract(host, '([^.]*\\.)?[^.]*$')"
_IS_TWO = f"{_LAST_TWO} IN ({', '.join(repr(x) for x in _TWO)})"


def _level(name: str, keys: str, table: str) -> str:
    return f"""{name}_m AS (
  SELECT CASE WHEN coalesce(b, 0) <= 0 THEN 1.0 ELSE 1 / least(greatest(a / b, 1e-3), 1.0 / 3) - 1 END AS s FROM (
    SELECT sum(n * (bad / n - prior) ** 2 - prior * (1 - prior)) AS a, sum((n - 1) * prior * (1 - prior)) AS b
    FROM {table} WHERE n > 0)),
{name} AS (SELECT {keys}, (bad + s * prior) / (n + s) AS mean, n + s AS mass FROM {table}, {name}_m)"""


OP3_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
label AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
outcome AS (
  SELECT host, count(*) AS n, sum(bad)::DOUBLE AS bad FROM parts
  JOIN label ON doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})[^/]*/?$', 1), '') AS BIGINT)
  WHERE bad IS NOT NULL GROUP BY host),
hosts AS (
  SELECT host, CASE WHEN {_IS_TWO} THEN {_LAST_TWO} ELSE regexp_extract(host, '[^.]*$') END AS suffix,
         CASE WHEN {_IS_TWO} THEN regexp_extract(host, '([^.]*\\.)?([^.]*\\.)?[^.]*$') ELSE {_LAST_TWO} END AS domain,
         coalesce(n, 0) AS n, coalesce(bad, 0.0) AS bad
  FROM (SELECT DISTINCT host FROM parts) LEFT JOIN outcome USING (host)),
overall AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS p FROM hosts),
suffix_n AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(p) AS prior FROM hosts, overall GROUP BY suffix),
{_level("suffix_p", "suffix", "suffix_n")},
domain_n AS (
  SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS prior
  FROM hosts JOIN suffix_p USING (suffix) GROUP BY suffix, domain),
{_level("domain_p", "suffix, domain", "domain_n")},
host_n AS (SELECT host, n, bad, mean AS prior FROM hosts JOIN domain_p USING (suffix, domain)),
{_level("host_p", "host", "host_n")},
bound AS (SELECT host, greatest(mean - 1.6449 * sqrt(mean * (1 - mean) / (mass + 1)), 0) AS lower FROM host_p)
SELECT page_id, host, path, CASE {_cases("rule")} END AS rule,
       coalesce(CASE {_cases("verdict")} END, CASE WHEN lower > 0.3 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts JOIN bound USING (host)
"""


#: Filter audit: failures by plain window and list functions, orders by joining the letters with themselves.
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT part,
    (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS bits,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false)::INT AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false)::INT AS toxic FROM d),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bs
  FROM l p, l q, l r, l s, l t WHERE p.b + q.b + r.b + s.b + t.b = 31 AND p.b | q.b | r.b | s.b | t.b = 31),
e AS (SELECT filter_order, step, bs[step] AS own, coalesce(list_sum(bs[:step - 1]), 0)::INT AS before FROM o, range(1, 6) AS x(step))
SELECT part, filter_order, step::INT AS step,
  sum(CASE WHEN bits & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN bits & own <> 0 AND bits & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN n ELSE 0 END)) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM c, e GROUP BY part, filter_order, step, own
"""

#: Ranked search: terms, counts and scores in plain aggregates; integers are 64 bits wide.
OP12_SQL = r"""
WITH i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (
  SELECT item_id, text, term, count(*) AS q FROM (
    SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
f AS (SELECT nr, term, count(*) AS tf FROM (SELECT nr, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
m AS (SELECT nr, doc_id, 100 - 25 + ((25 * len(terms) * n_docs) // n_terms)::BIGINT AS m FROM d, s WHERE len(terms) > 0),
p AS (
  SELECT item_id, text, nr, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (nr) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
"""

#: Contamination: all runs of words of each window length, joined with the windows as text.
OP1_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS s FROM (
  SELECT item_id, ws, least(len(ws), 13) AS n, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
g AS (SELECT nr, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s FROM (
  SELECT nr, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n)),
m AS (SELECT nr, i, n, item_id FROM g JOIN win USING (s, n)),
h AS (SELECT nr, count(DISTINCT p) AS n_hit FROM (SELECT nr, unnest(range(i, i + n)) AS p FROM m) GROUP BY nr),
t AS (SELECT nr, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM m GROUP BY nr)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (nr) LEFT JOIN t USING (nr)
"""
