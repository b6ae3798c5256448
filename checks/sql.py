"""Oracle side: DuckDB expressions and statements, written apart from the Spark rules."""

from __future__ import annotations

from checks import templates as t

# Hosts, sections, keywords and verbs of the link rules.
SOCIAL_HOSTS = "facebook|twitter|instagram|linkedin|youtube|tiktok|pinterest|reddit|whatsapp"
SECTIONS = ("legal terms privacy contact careers support blog events about faq investors search "
            "sitemap login register help company").split()
KEYWORDS = ("legal terms policy privacy contact careers conditions locations faq investors about settings cookies "
            "blog support help resources events login register account search sitemap media press directory community "
            "company").split()
VERBS = ("announce start end finish open close report initiate terminate invest join collaborate hire agree surpass "
         "applaud raise deliver unveil plan showcase introduce present grant sign complete receive give select partner "
         "signal continue stop win launch set visit achieve dismiss take accelerate reach indicate enter exit produce "
         "create make move host locate forms").split()


def names(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def path(u: str) -> str:
    return f"regexp_replace(lower({u}), '^https?://[^/]+', '')"


def social(u: str) -> str:
    return (f"(contains(lower({u}), '/x.com') OR contains(lower({u}), 'www.x.com') "
            f"OR regexp_matches({u}, '(?i)({SOCIAL_HOSTS})\\.com(/|$)'))")


def valid(u: str) -> str:
    return (f"({u} NOT IN ('/', '', '#', 'javascript:void(0)') AND NOT starts_with({u}, '#') AND NOT starts_with({u}, 'tel:') "
            f"AND NOT starts_with({u}, 'mailto:') AND NOT {social(u)})")


def typical(u: str, text: str) -> str:
    exact = names([f"/{s}" for s in SECTIONS] + [f"/{s}/" for s in SECTIONS])
    words = f"regexp_split_to_array(lower({text}), '[\\s-]+')"
    return (f"(list_contains({exact}, {path(u)}) OR ({text} <> '' AND len({words}) <= 4 "
            f"AND list_has_any({words}, {names(KEYWORDS)})))")


def typical_path(u: str) -> str:
    kinds = ("legal|privacy[-_]?policy|terms[-_]?(of[-_]?use|service)|about[-_]?(us)?|contact[-_]?(us)?|careers?|faq|"
             "investor[-_]?relations?|press|media|login|register|search|sitemap")
    return f"regexp_matches({path(u)}, '^/({kinds})(/|$)')"


def flags(u: str) -> dict[str, str]:
    rest = f"regexp_replace({u}, '^https?://', '')"
    host = f"split_part({rest}, '/', 1)"
    file = f"split_part(split_part({rest}, '?', 1), '#', 1)"
    return {
        "has_protocol": f"regexp_matches({u}, '^https?://')",
        "has_subdomain": f"(regexp_matches({host}, '^[a-zA-Z0-9-]+\\.') AND NOT starts_with({host}, 'www.'))",
        "has_port": f"regexp_matches({host}, ':[0-9]+')",
        "has_query": f"contains({u}, '?')",
        "has_fragment": f"contains({u}, '#')",
        "has_file_extension": f"regexp_matches(split_part({u}, '?', 1), '\\.[a-zA-Z0-9]+$')",
        "is_relative_url": f"starts_with({u}, '/')",
        "multi_level_path": f"(starts_with({u}, '/') OR (contains({file}, '/') AND len(list_filter(string_split({file}, '/'), lambda x: x <> '')) >= 2))",
    }


def slug(u: str) -> str:
    parts = f"string_split(rtrim(split_part(split_part({u}, '?', 1), '#', 1), '/'), '/')"
    return f"CASE WHEN regexp_matches({parts}[-1], '\\.[a-zA-Z0-9]+$') THEN {parts}[-2] ELSE {parts}[-1] END"


FORMS = f"""verbs AS (SELECT unnest({names(VERBS)}) AS verb),
forms AS (SELECT DISTINCT verb, unnest([verb, verb || 's', CASE WHEN verb LIKE '%y' THEN left(verb, -1) || 'ies' END,
  CASE verb WHEN 'take' THEN 'took' WHEN 'give' THEN 'gave' WHEN 'make' THEN 'made' WHEN 'win' THEN 'won' WHEN 'set' THEN 'set'
  ELSE CASE WHEN verb LIKE '%e' THEN verb || 'd' WHEN verb LIKE '%y' THEN left(verb, -1) || 'ied' ELSE verb || 'ed' END END]) AS form FROM verbs),
all_forms AS (SELECT list(DISTINCT form) AS forms FROM forms WHERE form IS NOT NULL)"""


def verb(u: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({slug(u)}), '[-_\\s.]'), lambda x: x <> '')"
    return f"coalesce(len({words}) > 1 AND list_has_any({words}, (SELECT forms FROM all_forms)), false)"


def absolute(u: str, base: str) -> str:
    return f"CASE WHEN starts_with({u}, 'http') THEN {u} ELSE rtrim({base}, '/') || '/' || ltrim({u}, '/') END"


FLAG_NAMES = list(flags("u"))

# Links of the given pages: their markup is regular, so a pattern finds the same links as the tree.
GIVEN_LINKS = """given AS (
  SELECT page_id, url, unnest(regexp_extract_all(body, '<a href="([^"]*)">', 1)) AS raw,
    unnest(regexp_extract_all(body, '<a href="[^"]*">([^<]*)</a>', 1)) AS raw_text,
    generate_subscripts(regexp_extract_all(body, '<a href="([^"]*)">', 1), 1) AS n
  FROM (SELECT page_id, url, regexp_replace(html, '<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '', 'gs') AS body FROM pages)),
links AS (SELECT page_id, url, n AS pos, replace(raw, '&amp;', '&') AS href, trim(replace(raw_text, '&amp;', '&')) AS text,
  '[document] > html > body > nav > ul > li' AS anc_flex, '[document] > html > body > nav > ul > li' AS anc_strict FROM given)"""


def groups(source: str) -> str:
    """CTEs ``firsts`` and ``groups`` over a source CTE with page_id, pos, anc_flex, anc_strict, href, text."""
    f = flags("href")
    per_link = ", ".join(f"{expr} AS {name}" for name, expr in f.items())
    counts = ", ".join(f"count(*) FILTER ({n}) AS {n}_count" for n in f)
    shares = ", ".join(f"{n}_count / n AS {n}_pct" for n in f)
    return f"""{FORMS},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, anc_flex, href ORDER BY pos) AS rn
  FROM {source} WHERE {valid("href")}) WHERE rn = 1),
facts AS (SELECT *, count(*) OVER (PARTITION BY page_id, href) > 1 AS shared, coalesce(length({slug("href")}), 0) AS slug_len,
  {verb("href")} AS verb, {typical("href", "text")} AS typical, {per_link} FROM firsts),
raw_groups AS (SELECT page_id, anc_flex AS ancestry, min(pos) AS first_pos, count(DISTINCT anc_strict) AS num_unique_strict_ancestry,
  list(href ORDER BY pos) AS urls, list_sort(list(href)) AS url_set, count(*) AS n, bool_or(shared) AS non_excl_url,
  count(*) FILTER (typical) AS num_typical_url, avg(slug_len) AS last_path_mean_length,
  list_sort(list(slug_len))[count(*) // 2 + 1] AS last_path_median_length, count(*) FILTER (verb) AS urls_with_verbs, {counts}
  FROM facts GROUP BY page_id, anc_flex),
groups AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY first_pos) - 1 AS group_id, n AS url_count,
  count(*) OVER (PARTITION BY page_id, url_set) > 1 AS twin_group, urls_with_verbs / n * 100 AS verb_percentage, {shares} FROM raw_groups),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url_set ORDER BY group_id) AS nth FROM groups) WHERE nth = 1),
cand AS (SELECT * FROM dedup WHERE num_typical_url = 0 AND url_count > 4 AND multi_level_path_pct = 1),
verbal AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY page_id) AS c, bool_or(verb_percentage > 20) OVER (PARTITION BY page_id) AS high FROM cand)
  WHERE NOT (c > 1 AND high) OR verb_percentage > 20),
longest AS (SELECT * FROM (SELECT *, max(last_path_median_length) OVER (PARTITION BY page_id) AS m FROM verbal) WHERE last_path_median_length = m),
largest AS (SELECT * FROM (SELECT *, max(url_count) OVER (PARTITION BY page_id) AS mc FROM longest) WHERE url_count = mc),
winner AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY page_id) AS k1 FROM largest) WHERE k1 = 1)"""


# Boilerplate words and header patterns.
BASIC = "copyright|all rights reserved|terms of (use|service)|privacy policy|contact us|share this|follow us|subscribe to"


def basic(x: str) -> str:
    return f"regexp_matches({x}, '(?i){BASIC}')"


def header(x: str, bold: str) -> str:
    line = f"lower(trim({x}))"
    strict = ("^forward[\\s-]*looking[\\s-]*statements?$|^safe\\s+harbor\\s+statements?$|^\\s*about\\s+[a-z\\s]+$|"
              "^\\s*[a-z\\s]+['']?s\\s+safe\\s+harbor\\s+statement$")
    lenient = ("^.*forward[\\s-]*looking[\\s-]*statements?.*$|^.*safe\\s+harbor\\s+statements?.*$|^.*about\\s+[a-z\\s]+.*$|"
               "^.*[a-z\\s]+['']?s\\s+safe\\s+harbor\\s+statement.*$")
    return f"(NOT {basic(x)} AND (regexp_matches({line}, '{strict}') OR ({bold} AND regexp_matches({line}, '{lenient}'))))"


BOLD = ("(parent_tag IN ('b', 'strong') OR contains(lower(parent_style), 'font-weight: bold') "
        "OR contains(lower(parent_class), 'bold'))")

LINES = f"""lines AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS seq, text, parent_tag, parent_class,
  parent_style FROM ({t.TEXT_NODES})),
judged AS (SELECT *, {basic("text")} AS is_boilerplate, {header("text", BOLD)} AS is_header FROM lines)"""


def dates(source: str) -> str:
    """CTE ``found``: page_id, seq, pattern_no, day of every readable text date up to now."""
    p2 = "regexp_extract(text, '(\\d{1,2})/(\\d{1,2})/(\\d{2,4})', ['a', 'b', 'c'])"
    p3 = ("regexp_extract(text, '((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*) (\\d{1,2}),? (\\d{4})', ['m', 'd', 'y'])")
    return f"""tried AS (SELECT page_id, seq, text, regexp_extract(text, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS iso, {p2} AS s, {p3} AS w FROM {source}),
split AS (SELECT *, TRY_CAST(s.a AS INT) AS a, TRY_CAST(s.b AS INT) AS b,
  CASE WHEN length(s.c) = 2 THEN TRY_CAST(s.c AS INT) + CASE WHEN TRY_CAST(s.c AS INT) + 2000 >= year(current_date) + 50 THEN 1900 ELSE 2000 END
  ELSE TRY_CAST(s.c AS INT) END AS c FROM tried),
found AS (SELECT * FROM (
  SELECT page_id, seq, text, 1 AS pattern_no, TRY_CAST(iso AS DATE) AS day FROM split
  UNION ALL SELECT page_id, seq, text, 2, CASE WHEN a > 12 THEN TRY_CAST(printf('%04d-%02d-%02d', c, b, a) AS DATE)
    ELSE TRY_CAST(printf('%04d-%02d-%02d', c, a, b) AS DATE) END FROM split WHERE s.a <> ''
  UNION ALL SELECT page_id, seq, text, 3, coalesce(TRY_STRPTIME(w.d || ' ' || w.m || ' ' || w.y, '%-d %B %Y'),
    TRY_STRPTIME(w.d || ' ' || replace(w.m, 'Sept', 'Sep') || ' ' || w.y, '%-d %b %Y'))::DATE FROM split WHERE w.d <> '')
  WHERE day IS NOT NULL AND day <= current_date)"""


# What the article template must give, from its parts.
ARTICLE = f"""parts AS ({t.ARTICLES}),
titled AS (SELECT *, og IS NOT NULL AND length(og) < 200 AS og_ok,
  og IS NULL AND ld_title IS NULL AND story IS NULL AS use_loose FROM parts),
cands AS (SELECT page_id, 1 AS prio, og AS text FROM titled WHERE og_ok UNION ALL
  SELECT page_id, 2, ld_title FROM titled WHERE ld_title IS NOT NULL UNION ALL
  SELECT page_id, 3, story FROM titled WHERE story IS NOT NULL UNION ALL
  SELECT page_id, 4, loose_h1 FROM titled WHERE use_loose AND loose_h1 IS NOT NULL),
best AS (SELECT page_id, prio, text AS title FROM
  (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(text) DESC, prio) AS rn FROM cands) WHERE rn = 1),
dated AS (SELECT page_id, CASE WHEN og_date IS NOT NULL THEN og_date || ' 00:00:00'
    WHEN meta_date IS NOT NULL THEN replace(meta_date, 'T', ' ')
    WHEN ld_date IS NOT NULL THEN '2021-03-' || lpad(CAST(k % 28 + 1 AS STRING), 2, '0') || ' 00:00:00'
    ELSE text_date || ' 00:00:00' END AS published_text,
  CASE WHEN og_date IS NOT NULL OR meta_date IS NOT NULL THEN 'meta' WHEN ld_date IS NOT NULL THEN 'json_ld'
    WHEN text_date IS NOT NULL THEN 'text' END AS method FROM parts),
meta AS (SELECT page_id, CASE author_method WHEN 1 THEN 'Ann ' || CAST(k AS STRING) WHEN 2 THEN 'Bob ' || CAST(k AS STRING)
    WHEN 3 THEN 'Cy ' || CAST(k AS STRING) WHEN 4 THEN 'ByDi ' || CAST(k AS STRING) END AS author, author_method,
  CASE WHEN keywords_text IS NOT NULL THEN '["alpha","beta","","' || seg || '"]' END AS keywords_json, category FROM parts),
counted AS (SELECT page_id,
  CAST(CASE WHEN k % 10 = 4 THEN 1 ELSE 0 END + dates_n + 4 + CASE WHEN k % 7 = 3 THEN 1 ELSE 0 END
    + CASE WHEN is_cut THEN 0 ELSE 1 END AS BIGINT) AS n_content,
  CAST(CASE WHEN k % 6 = 1 THEN 1 ELSE 0 END + CASE WHEN is_cut THEN 0 ELSE 1 END AS BIGINT) AS n_tables FROM parts)"""
