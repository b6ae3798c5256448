"""URL classification as Column expressions: no UDF, every rule stays in generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressframe.functions.text import END, SPACES, WS

# Social networks, each followed by ".com".
SOCIAL = "facebook twitter instagram linkedin youtube tiktok pinterest reddit whatsapp".split()

# Site sections whose bare path marks a navigation link.
SECTION_PATHS = (
    "legal terms privacy contact careers support blog events about faq investors search "
    "sitemap login register help company"
).split()

# Words that mark a short anchor text as navigation.
SECTION_WORDS = (
    "legal terms policy privacy contact careers conditions locations faq investors about settings "
    "cookies blog support help resources events login register account search sitemap media press "
    "directory community company"
).split()

# Path patterns of the older, path-only classifier.
LEGACY_PATHS = [
    "legal", "privacy[-_]?policy", "terms[-_]?(of[-_]?use|service)", "about[-_]?(us)?",
    "contact[-_]?(us)?", "careers?", "faq", "investor[-_]?relations?", "press", "media",
    "login", "register", "search", "sitemap",
]

# Verbs of press headlines, and the past forms that do not follow the suffix rules.
VERBS = (
    "announce start end finish open close report initiate terminate invest join collaborate hire "
    "agree surpass applaud raise deliver unveil plan showcase introduce present grant sign invest "
    "complete receive grant give select partner signal continue stop win launch set visit achieve "
    "dismiss take accelerate reach indicate enter exit produce create make move host locate forms"
).split()
IRREGULAR = {"take": "took", "give": "gave", "make": "made", "begin": "began", "win": "won",
             "set": "set", "create": "created"}

# Suffix rules (pattern, replacement); for the past form the first rule that fits is used.
PRESENT_RULES = [(r"$", "s"), (r"y$", "ies")]
PAST_RULES = [(r"e$", "ed"), (r"y$", "ied"), (r"$", "ed")]

HOSTLESS_LINKS = ["/", "", "#", "javascript:void(0)"]
_EXTENSION = r"\.[a-zA-Z0-9]+" + END
_SPLIT_LIMIT = -1


def url_path(url: Column) -> Column:
    """URL without scheme and host, in lower case."""
    low = F.lower(url)
    return F.when(low.startswith("http"), F.regexp_replace(low, r"^https?://[^/]+", "")).otherwise(low)


def is_social(url: Column) -> Column:
    low = F.lower(url)
    hosts = "|".join(SOCIAL)
    # No other letters are c, o or m in lower case, so a plain search spares most relative links the pattern.
    return (low.contains("/x.com") | low.contains("www.x.com")
            | (low.contains(".com") & url.rlike(rf"(?iu)(?:{hosts})\.com(?:/|{END})")))


def is_typical(href: Column, text: Column | None = None, mode: str = "full") -> Column:
    """Is the link a usual site section?  ``mode='path'`` applies the older path patterns only."""
    path = url_path(href)
    if mode == "path":
        return path.rlike("(?iu)^/(?:" + "|".join(LEGACY_PATHS) + rf")(?:/|{END})")
    return is_section(path) | is_section_text(text, text_words(text))


def is_section(path: Column) -> Column:
    return path.isin([f"/{s}{tail}" for s in SECTION_PATHS for tail in ("", "/")])


def text_words(text: Column) -> Column:
    low = F.lower(text)
    # Most texts hold single blanks only, and need no pattern for them.
    runs = low.rlike("[^ -~]") | low.contains("  ") | low.contains(" -") | low.contains("- ") | low.contains("--")
    dashed = F.when(runs, F.regexp_replace(low, f"[{WS}-]+", "-")).otherwise(F.replace(low, F.lit(" "), F.lit("-")))
    return F.split(dashed, "-", _SPLIT_LIMIT)


def is_section_text(text: Column, words: Column) -> Column:
    """Is a link's short text one for a usual site section, by its ``text_words``?"""
    short = (F.size(words) <= 4) & F.exists(words, lambda w: w.isin(SECTION_WORDS))
    return F.coalesce((text != "") & short, F.lit(False))


def url_flags(url: Column) -> dict[str, Column]:
    """The eight structure flags of a URL."""
    rest = F.regexp_replace(url, r"^https?://", "")
    host = F.substring_index(rest, "/", 1)
    path = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    segments = F.array_remove(F.split(path, "/", _SPLIT_LIMIT), "")
    relative = url.startswith("/")
    return {
        "has_protocol": url.rlike(r"^https?://"),
        "has_subdomain": host.rlike(r"^(?!www\.)[a-zA-Z0-9-]+\."),
        "has_port": host.rlike(r":[0-9]+"),
        "has_query": url.contains("?"),
        "has_fragment": url.contains("#"),
        "has_file_extension": F.substring_index(url, "?", 1).rlike(_EXTENSION),
        "is_relative_url": relative,
        "multi_level_path": relative | (path.contains("/") & (F.size(segments) >= 2)),
    }


def slug(url: Column) -> Column:
    """Last path segment, or the one before it when the last is a file; null when there is none."""
    clean = F.rtrim(F.substring_index(F.substring_index(url, "?", 1), "#", 1), F.lit("/"))
    last = F.substring_index(clean, "/", -1)
    before = F.when(clean.contains("/"), F.substring_index(F.substring_index(clean, "/", -2), "/", 1))
    return F.when(last.contains(".") & last.rlike(_EXTENSION), before).otherwise(last)


def slug_length(url: Column) -> Column:
    return F.coalesce(F.length(slug(url)), F.lit(0))


def slug_words(url: Column) -> Column:
    # One delimiter, so the split needs no regex.
    dashed = F.translate(F.lower(slug(url)), f"_.{SPACES}", "-" * (2 + len(SPACES)))
    return F.array_remove(F.split(dashed, "-", _SPLIT_LIMIT), "")


def verb_table(spark: SparkSession) -> DataFrame:
    """``(verb, form)``: each distinct verb with its base, -s and past forms."""
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    verb = F.col("verb")
    regular = F.coalesce(*[F.when(verb.rlike(p), F.regexp_replace(verb, p, r)) for p, r in PAST_RULES])
    present = [F.when(verb.rlike(p), F.regexp_replace(verb, p, r)) for p, r in PRESENT_RULES]
    past = F.coalesce(F.try_element_at(irregular, verb), regular)
    return (spark.createDataFrame([(v,) for v in VERBS], "verb string").distinct()
            .select("verb", F.explode(F.array_distinct(F.array(verb, *present, past))).alias("form"))
            .where("form is not null"))


def verb_forms() -> list[str]:
    """All forms as literals, for use inside expressions."""
    forms = set(VERBS)
    for verb in VERBS:
        forms.update(re.sub(p, r, verb, count=1) for p, r in PRESENT_RULES if re.search(p, verb))
        past = next(re.sub(p, r, verb, count=1) for p, r in PAST_RULES if re.search(p, verb))
        forms.add(IRREGULAR.get(verb, past))
    return sorted(forms)


def has_verb(url: Column) -> Column:
    """Does the slug hold at least two words, one of them a verb form?"""
    return words_have_verb(slug_words(url))


def words_have_verb(words: Column) -> Column:
    # A membership test per word is one hash look-up; arrays_overlap would walk all forms per row.
    hit = F.exists(words, lambda w: w.isin(verb_forms()))
    return F.coalesce((F.size(words) > 1) & hit, F.lit(False))


def absolute_url(href: Column, base: Column, mode: str = "prefix") -> Column:
    """Absolute form of a link.

    ``prefix`` puts the whole base URL, as given, before every link that does not start with
    "http".  ``rfc3986`` resolves the link as a browser does (scheme, host, path, query and
    dot segments).
    """
    if mode == "prefix":
        joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(href, F.lit("/")))
        return F.when(href.startswith("http"), href).otherwise(joined)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_file = F.regexp_extract(base, r"^([^?#]*)", 1)
    base_path = F.regexp_extract(base_file, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)?$", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*$", ""))
    raw_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    full = F.when(raw_path.startswith("/"), raw_path).otherwise(F.concat(folder, raw_path))
    parts = F.split(full, "/", _SPLIT_LIMIT)
    # Dot segments: "." disappears, ".." takes the segment before it away.
    walked = F.reduce(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    closing = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(walked) > 0), F.lit("/")).otherwise(F.lit(""))
    path = F.concat(F.lit("/"), F.array_join(walked, "/"), closing)
    has_query = F.when(href.startswith("#"), F.regexp_extract(base, r"^[^#]*?(\?[^#]*)?(?:#.*)?$", 1)).otherwise("")
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href == "", F.regexp_replace(base, "#.*$", ""))
            .when(raw_path == "", F.concat(base_file, has_query, tail))
            .otherwise(F.concat(origin, path, tail)))


def is_news_link(href: Column) -> Column:
    """Link filter applied before grouping (case-sensitive prefixes)."""
    prefixed = href.startswith("#") | href.startswith("tel:") | href.startswith("mailto:")
    return href.isNotNull() & ~href.isin(HOSTLESS_LINKS) & ~prefixed & ~is_social(href)
