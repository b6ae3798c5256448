"""Boilerplate and section-header rules for one line of text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pressframe.functions.text import END, WS, any_of, strip

# Phrases that make a line boilerplate wherever they stand.
BASIC = ["copyright", "all rights reserved", "terms of (use|service)", "privacy policy",
         "contact us", "share this", "follow us", "subscribe to"]

# Section headers, tested on the stripped lower-case line.  `S` stands for white space.
STRICT = ["^forward[S-]*looking[S-]*statements?$", "^safe[S]+harbor[S]+statements?$",
          "^[S]*about[S][a-zS]+$", "^[S]*[a-zS]+'?s[S]+safe[S]+harbor[S]+statement$"]

# The same phrases inside a longer line, for bold text only.  A possessive run is enough after "about":
# the longest run of letters and blanks leaves the shortest rest.
LENIENT = ["^.*forward[S-]*looking[S-]*statements?.*$", "^.*safe[S]+harbor[S]+statements?.*$",
           "^.*about[S][a-zS]++.*$"]
HEADER_WORDS = "looking|harbor|about"
# Letters that also count as an s or an i where case is ignored.
ODD_LETTERS = "\u017f\u0131\u0130"
LENIENT_OWNER = "^.*[a-zS]+'?s[S]+safe[S]+harbor[S]+statement.*$"
OWNER_PHRASE = "s[S]+safe[S]+harbor[S]+statement"


def _regex(*patterns: str) -> str:
    # (?d): only \n ends a line for `.`; `$` is spelt out because Java's differs from Python's.
    body = "|".join(p.replace("S", WS).replace("$", END) for p in patterns)
    return f"(?diu)(?:{body})"


def _may_hold(text: Column, low: Column, words: list[str]) -> Column:
    """False where none of the words is there in any case.  Plain searches settle most lines many times as fast as a pattern;
    text with an odd letter is left to that."""
    return reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in ODD_LETTERS] + [F.contains(low, F.lit(w)) for w in words])


def is_basic(text: Column, low: Column | None = None) -> Column:
    """``low`` is the text in lower case, where that is there already."""
    return _may_hold(text, F.lower(text) if low is None else low, [p.partition("(")[0] for p in BASIC]) & any_of(text, BASIC)


def is_strict_header(text: Column) -> Column:
    return F.lower(strip(text)).rlike(_regex(*STRICT))


def has_header_phrase(text: Column) -> Column:
    line = F.lower(strip(text))
    # The last pattern backtracks on long text, so a plain search for its phrase goes first.
    owner = F.when(line.rlike(_regex(OWNER_PHRASE)), line.rlike(_regex(LENIENT_OWNER))).otherwise(F.lit(False))
    return line.rlike(_regex(*LENIENT)) | owner


def is_bold(tag: Column, css_class: Column, style: Column) -> Column:
    """Bold by tag, by inline style or by a class name of the enclosing element."""
    return (F.coalesce(tag.isin("b", "strong"), F.lit(False))
            | F.coalesce(F.lower(style).contains("font-weight: bold"), F.lit(False))
            | F.coalesce(F.lower(css_class).contains("bold"), F.lit(False)))


def boilerplate(text: Column, tag: Column, css_class: Column, style: Column) -> tuple[Column, Column]:
    """``(is_boilerplate, is_section_header)``; boilerplate wins over header."""
    basic = is_basic(text)
    return basic, is_header(text, tag, css_class, style, may_be_header(text), basic)


def may_be_header(text: Column, low: Column | None = None) -> Column:
    """Every header holds one of three words, so most lines are settled by this short search."""
    low = F.lower(text) if low is None else low
    return _may_hold(text, low, HEADER_WORDS.split("|")) & low.rlike(f"(?iu){HEADER_WORDS}")


def is_header(text: Column, tag: Column, css_class: Column, style: Column, may_be: Column, basic: Column) -> Column:
    """Section header, from what :func:`may_be_header` and :func:`is_basic` say of the line."""
    return may_be & ~basic & (is_strict_header(text) | (has_header_phrase(text) & is_bold(tag, css_class, style)))


def bold_test_breaks(text: Column, tag: Column, css_class: Column, style: Column, may_be: Column, basic: Column) -> Column:
    """Lines on which the test for bold classes finds no single class to look at; the last two as for :func:`is_header`."""
    by_tag_or_style = is_bold(tag, F.lit(""), style)
    return may_be & F.coalesce(css_class != "", F.lit(False)) & ~by_tag_or_style & ~basic & has_header_phrase(text)
