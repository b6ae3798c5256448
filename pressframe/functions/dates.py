"""Date reading, on the JVM throughout.  Common shapes are rebuilt from captured groups; a value that fits none
of them is taken apart: clock and zone, weekday, then up to three numbers or month names whose
order says which is the year, the month and the day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from pressframe.functions.text import strip

# The three text shapes, in the order they are tried.
DATE_PATTERNS = [
    r"\d{4}-\d{2}-\d{2}",
    r"\d{1,2}/\d{1,2}/\d{2,4}",
    r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{1,2},? \d{4}",
]
# Words near a date that speak for a publication date.
PUBLICATION_WORDS = ["press", "release", "published", "posted"]

MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]
_ISO = (r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?(Z|[+-]\d{2}:?\d{2})?)?\z")


def _month_number() -> Column:
    names = {name[:3]: i for i, name in enumerate(MONTH_NAMES, 1)}
    names.update({name: i for i, name in enumerate(MONTH_NAMES, 1)})
    names["Sept"] = 9
    return F.expr("map(" + ", ".join(f"'{name}', {i}" for name, i in names.items()) + ")")


_DAY_MONTH = (r"^(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? )?(\d{1,2}) ([A-Z][a-z]{2,8}) (\d{4})"
              r"(?: (\d{2}:\d{2}:\d{2})(?: (GMT|UTC|[+-]\d{4}))?)?\z")
_MONTH_DAY = r"^([A-Z][a-z]{2,8}) (\d{1,2}),? (\d{4})\z"


def _near_year(number: Column, as_of: Column) -> Column:
    """Years below 100 fall within 50 years of ``as_of``."""
    this_year = F.year(as_of)
    guess = number + (this_year - F.pmod(this_year, F.lit(100)))
    near = (F.when(guess >= this_year + 50, guess - 100)
            .when(guess < this_year - 50, guess + 100).otherwise(guess))
    return F.when(number < 100, near).otherwise(number)


def _full_year(text: Column, as_of: Column) -> Column:
    """Years of more than two digits are taken as written."""
    number = text.cast("int")
    return F.when(F.length(text) > 2, number).otherwise(_near_year(number, as_of))


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"),
                       F.lpad(day.cast("string"), 2, "0"))
    possible = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.when(possible, F.try_to_date(text, "yyyy-MM-dd"))


def _group(text: Column, regex: str, n: int) -> Column:
    return F.nullif(F.regexp_extract(text, regex, n), F.lit(""))


def text_dates(text: Column, as_of: Column) -> list[Column]:
    """One DATE column per pattern: the first hit of that pattern in the text, null when it is no date.

    Each group is looked for once, however often it is used."""
    def found(regex: str, body: Callable[[Column, Column, Column], Column]) -> Column:
        groups = F.struct(*[_group(text, regex, i).alias(f"g{i}") for i in (1, 2, 3)])
        return _let(groups, lambda g: body(g["g1"], g["g2"], g["g3"]))

    def iso(y: Column, m: Column, d: Column) -> Column:
        return _date(y.cast("int"), m.cast("int"), d.cast("int"))

    def slashed(a: Column, b: Column, c: Column) -> Column:
        first, second, third = a.cast("int"), b.cast("int"), c.cast("int")
        # Month first, unless the first number can only be a day (over 12) or a year (over 31).
        return (F.when(first > 31, _date(_full_year(a, as_of), second, third))
                .when(first > 12, _date(_full_year(c, as_of), second, first))
                .otherwise(_date(_full_year(c, as_of), first, second)))

    def named(name: Column, d: Column, y: Column) -> Column:
        month, day, year = F.try_element_at(_month_number(), name), d.cast("int"), y.cast("int")
        # With a year like 0012 nothing marks the last number as the year, so a "day" over 31 is it.
        return (F.when((day > 31) & (year <= 100), _date(_near_year(day, as_of), month, year))
                .otherwise(_date(_near_year(year, as_of), month, day)))

    return [found(r"(\d{4})-(\d{2})-(\d{2})", iso), found(r"(\d{1,2})/(\d{1,2})/(\d{2,4})", slashed),
            found(r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*) (\d{1,2}),? (\d{4})", named)]


def has_text_date(text: Column) -> Column:
    """Some pattern is there.  Each holds a digit after a dash, a slash or a word, which is tested
    first, from the digit back: the full alternation is slow on long text."""
    return text.rlike(r"\d(?<=\d[-/]\d|[a-z] \d)") & text.rlike("|".join(DATE_PATTERNS))


def _named_month(value: Column) -> Column:
    """Mail dates (RFC 2822) and dates with a named month, as canonical text; null for other shapes."""
    months = _month_number()

    def day(number: int, month: int, year: int, shape: str) -> Column:
        return _date(_group(value, shape, year).cast("int"), F.try_element_at(months, _group(value, shape, month)),
                     _group(value, shape, number).cast("int"))

    clock, zone = _group(value, _DAY_MONTH, 4), _group(value, _DAY_MONTH, 5)
    zone = F.when(zone.isin("GMT", "UTC"), F.lit("+00:00")).otherwise(
        F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
    mail = F.concat(day(1, 2, 3, _DAY_MONTH).cast("string"), F.lit(" "), F.coalesce(clock, F.lit("00:00:00")), F.coalesce(zone, F.lit("")))
    plain = F.concat(day(2, 1, 3, _MONTH_DAY).cast("string"), F.lit(" 00:00:00"))
    return F.coalesce(_let(mail, lambda m: F.when(F.try_to_timestamp(m).isNotNull(), m)), plain)


_WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
_JUMPS = ["at", "on", "and", "ad", "m", "t", "of", "st", "nd", "rd", "th", " ", ".", ",", ";", "-", "/", "'"]
_UTC = ["UTC", "GMT", "Z", "z"]
_SPACES = r"[\s\h\x1c-\x1f\x85\x{2028}\x{2029}]+"
_MONTH_WORD = "(?i:" + "|".join(sorted({*MONTH_NAMES, *(m[:3] for m in MONTH_NAMES), "Sept"}, key=len, reverse=True)) + ")"
_DAY_WORD = "(?i:" + "|".join(f"{d}|{d[:3]}" for d in _WEEKDAYS) + ")"
_CLOCK = (r"(?<![\d:.])(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,9}))?)?(?![\d:])"
          r"(?: ?([aApP])(?:\.? ?[mM])?\.?(?![a-zA-Z]))?")
_ZONE_NAME = rf"(?!(?:{_MONTH_WORD}|{_DAY_WORD})(?![a-zA-Z]))(?:[A-Z]{{1,5}}|z)(?![a-zA-Z])"
_OFFSET = r"[+-](?:\d{4}|\d{1,2}:\d{2}|\d{1,2})(?![\d:])(?: \([A-Z]{3,5}\))?"
#: Digits without separators, clocks by letters and numbers with a decimal, in plainer shapes.
_PLAINER = [
    (_SPACES, " "),
    (r"(?<![\d.:])(\d{4})(\d\d)(\d\d)[tT ]?(\d\d)(\d\d)(\d\d)(?!\d)", "$1-$2-$3 $4:$5:$6"),
    (r"(?<![\d.:])(\d{4})(\d\d)(\d\d)[tT ]?(\d\d)(\d\d)(?![\d.])", "$1-$2-$3 $4:$5"),
    (r"(?<![\d.:])(\d{4})(\d\d)(\d\d)(?![\d.])", "$1-$2-$3"),
    (r"^(\d\d)(\d\d)(\d\d)(?![\d.])", "$1/$2/$3"),
    (r"(?i)(?<![\d:.])(\d{1,2}) ?h(?:ours?)? ?(\d{1,2})(?: ?m(?:inutes?)?)?(?![a-z\d])", "$1:$2"),
    (r"(?<![\d:.])(\d{1,2}) ?([aApP])(?:\.?[mM])?\.?(?![a-zA-Z])", "$1:00 $2m"),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _clock_text(value: Column) -> Column:
    """``HH:mm:ss[.ffffff]`` of the clock in a text, midnight without one, null for a clock that cannot be."""
    hour, minute, second, fraction, half = (_group(value, _CLOCK, i) for i in range(1, 6))
    late = F.lower(half) == "p"
    hour, minute, second = _number(hour), _number(minute), _number(F.coalesce(second, F.lit("0")))
    possible = (hour <= F.when(half.isNull(), 23).otherwise(12)) & (minute <= 59) & (second <= 59)
    hour = F.when(half.isNull(), hour).when(late & (hour < 12), hour + 12).when(~late & (hour == 12), 0).otherwise(hour)
    micro = F.rpad(F.substring(F.coalesce(fraction, F.lit("")), 1, 6), 6, "0")
    text = F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in (hour, minute, second)])
    text = F.concat(text, F.when(micro == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micro)))
    return F.when(~value.rlike(_CLOCK), F.lit("00:00:00")).when(possible, text)


def _zone_text(zone: Column) -> Column:
    """``+hh:mm`` of a zone's name and offset, empty where neither gives one, null for an offset of a day or more.

    An offset written onto a name counts the other way ("GMT+3" is three hours behind); next to a name of UTC, one set apart counts nothing.
    """
    name, inside = _group(zone, r"^,? ?([A-Za-z]+)", 1), _group(zone, r"\(([A-Z]+)\)", 1)
    sign, offset = _group(zone, r"([+-])", 1), _group(zone, r"[+-]([\d:]+)", 1)
    joined = zone.rlike("[A-Za-z][+-]")
    hours = F.when(F.length(offset) == 4, F.when(offset.contains(":"), F.substring(offset, 1, 1)).otherwise(F.substring(offset, 1, 2))).otherwise(
        F.substring_index(offset, ":", 1))
    minutes = F.when(F.length(offset) >= 4, F.substring(offset, -2, 2)).otherwise("0")
    total = _number(hours) * 60 + _number(minutes)
    behind = (sign == "-") != joined
    universal = F.coalesce(F.when(~joined, name), inside).isin(_UTC)
    total = F.when(F.coalesce(universal, F.lit(False)), 0).otherwise(total)
    text = F.concat(F.when(behind & (total > 0), "-").otherwise("+"), F.lpad(F.floor(total / 60).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((total % 60).cast("string"), 2, "0"))
    return (F.when(offset.isNotNull(), F.when(total < 24 * 60, text))
            .when(name.isin(_UTC), F.lit("+00:00")).otherwise(F.lit("")))


def _members(rest: Column) -> Column:
    """Numbers and month names in order, as structs of number and kind: month, year (by its digits) or open; null if other words are there."""
    marked = F.regexp_replace(rest, r"(?<=[-/.])(\d{3,}+)|(?<!\d)(\d{3,}+)(?=[-/.])", "#$1$2")  # beside a separator, three digits make a year
    months = _month_number()

    def member(token: Column) -> Column:
        digits = token.rlike(r"^#?\d")
        number = F.when(digits, _number(F.ltrim(token, F.lit("#")))).otherwise(F.try_element_at(months, F.initcap(token)))
        kind = (F.when(digits, F.when(token.startswith("#") | (number > 100), "y").otherwise("d"))
                .when(number.isNotNull(), "m").when(F.lower(token).isin(_JUMPS), "").otherwise("?"))
        return F.struct(number.alias("n"), kind.alias("kind"))

    def known(found: Column) -> Column:
        return F.when(~F.exists(found, lambda x: x["kind"] == "?"), F.filter(found, lambda x: x["kind"] != ""))

    tokens = F.regexp_extract_all(marked, F.lit(r"(#?\d+|[A-Za-z]+|[^A-Za-z\d])"), F.lit(1))
    stuck = rest.rlike(rf"(?<!\d)(?:3[2-9]|[4-9]\d|\d{{3,}}+)(?={_MONTH_WORD})")
    return F.when(~rest.contains("#") & ~stuck, _let(F.transform(tokens, member), known))


def _order(found: Column) -> Column:
    """Which member is what, as letters in their order; null when there are too many or two of a kind."""
    first, second = F.get(found, F.lit(0))["n"], F.get(found, F.lit(1))["n"]
    lone = F.array_join(F.transform(found, lambda x: F.when(x["kind"] == "m", "m").when(x["n"] > 31, "y").otherwise("d")), "")

    def of(kinds: Column) -> Column:
        unclear = F.length(kinds) - F.length(F.regexp_replace(kinds, "d", ""))
        return (F.when((F.length(kinds) > 3) | kinds.rlike("m.?m|y.?y"), None)
                .when((unclear == 0) | ((F.length(kinds) == 3) & (unclear == 1)), kinds)
                .when((F.length(kinds) == 1) | ((F.length(kinds) == 2) & kinds.contains("m")), lone)
                .when(F.length(kinds) == 2, F.when(first > 31, "ym").when(second > 31, "my").otherwise("md"))
                .when(kinds.startswith("m"), F.when(second > 31, "myd").otherwise("mdy"))
                .when(F.substring(kinds, 2, 1) == "m", F.when(first > 31, "ymd").otherwise("dmy"))
                .when(kinds.endswith("m"), F.when(second > 31, "dym").otherwise("ydm"))
                .otherwise(F.when((first > 31) | kinds.startswith("y"), "ymd").when(first > 12, "dmy").otherwise("mdy")))

    return _let(F.array_join(F.transform(found, lambda x: x["kind"]), ""), of)


def _day_of(found: Column, order: Column, weekday: Column, as_of: Column) -> Column:
    """The date; what is missing comes from ``as_of``, a weekday without a day is the next one."""
    year, month, day = (F.get(found, F.instr(order, x) - 1)["n"] for x in "ymd")
    year = _let(year, lambda y: F.when(F.exists(found, lambda x: x["kind"] == "y"), y).otherwise(_near_year(y, as_of)))
    names = F.split(F.lit(",".join(d[:3] for d in _WEEKDAYS)), ",")
    number = F.array_position(names, F.initcap(F.substring(weekday, 1, 3))).cast("int") - 1

    def without_day(first: Column) -> Column:
        some = F.date_add(first, F.least(F.dayofmonth(as_of), F.dayofmonth(F.last_day(first))) - 1)
        return _let(some, lambda x: F.when(weekday.isNull(), x).otherwise(F.date_add(x, F.pmod(number - F.weekday(x), F.lit(7)))))

    parts = F.struct(F.coalesce(year, F.year(as_of)).alias("y"), F.coalesce(month, F.month(as_of)).alias("m"), day.alias("d"))
    return _let(parts, lambda p: F.when(F.instr(order, "d") == 0, _let(_date(p["y"], p["m"], F.lit(1)), without_day))
                .when(order.isNotNull(), _date(p["y"], p["m"], p["d"])))


def _free_form(value: Column, as_of: Column) -> Column:
    """Canonical text of a date in any order of its parts, null if something in it is no part of a date."""
    for shape, plainer in _PLAINER:
        value = F.regexp_replace(value, shape, plainer)
    beside, at_end = rf"((?:,? ?{_ZONE_NAME})?(?: ?{_OFFSET})?)", rf"((?: {_ZONE_NAME}(?: ?{_OFFSET})?| {_OFFSET}))$"
    weekday, short = rf"(?<![a-zA-Z])({_DAY_WORD})(?![a-zA-Z])", r"(?<![\d.,])(?=[\d.]{6}(?![\d.]))\d+\.\d+(?!\d)"

    def without_clock(text: Column) -> Column:
        return F.struct(text.alias("text"), F.regexp_extract(text, _CLOCK + beside, 6).alias("zone"),
                        F.regexp_replace(text, _CLOCK + beside, " ").alias("rest"))

    def without_zone(x: Column) -> Column:
        looks = x["text"].rlike(_CLOCK) & (x["zone"] == "")
        return F.struct(x["text"].alias("text"), F.when(looks, F.regexp_extract(x["rest"], at_end, 1)).otherwise(x["zone"]).alias("zone"),
                        F.when(looks, F.regexp_replace(x["rest"], at_end, "")).otherwise(x["rest"]).alias("rest"))

    def apart(x: Column) -> Column:
        rest = F.regexp_replace(x["rest"], weekday, "")
        whole = _let(rest, lambda r: F.when(~r.rlike(short), F.regexp_replace(
            F.regexp_replace(r, r"(?<![\d.,])(\d+)\.\d+(?![\d.])", "$1"), r"(?<![\d.,])(\d\d+),\d+(?![\d.,])", "$1")))
        return F.struct(_clock_text(x["text"]).alias("clock"), _let(x["zone"], _zone_text).alias("zone"), x["text"].rlike(_CLOCK).alias("has_clock"),
                        # The M of "A.M." counts as a zone.
                        x["text"].rlike(rf"[aApP]\.M\.? ?{_ZONE_NAME}").alias("two_zones"),
                        _group(x["rest"], weekday, 1).alias("weekday"), _let(whole, _members).alias("found"))

    def together(x: Column) -> Column:
        there = x["has_clock"] | x["weekday"].isNotNull() | (F.size(x["found"]) > 0)
        day = _let(_order(x["found"]), lambda order: _day_of(x["found"], order, x["weekday"], as_of))
        return F.when(there & ~x["two_zones"], F.concat(day.cast("string"), F.lit(" "), x["clock"], x["zone"]))

    for step in (without_clock, without_zone, apart, together):
        value = _let(value, step)
    return value


def published_text(value: Column, as_of: Column) -> Column:
    """Canonical ``yyyy-MM-dd HH:mm:ss[.ffffff][+hh:mm]`` text of a free-form date, null if unreadable."""
    def common(value: Column) -> Column:
        day, minute, second = (_group(value, _ISO, i) for i in (1, 2, 3))
        fraction, zone = _group(value, _ISO, 4), _group(value, _ISO, 5)
        zone = F.when(zone == "Z", F.lit("+00:00")).when(
            F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2))).otherwise(zone)
        fraction = F.when(fraction.cast("int") > 0, F.concat(F.lit("."), F.rpad(fraction, 6, "0")))
        text = F.concat(day, F.lit(" "), F.coalesce(minute, F.lit("00:00")), F.lit(":"), F.coalesce(second, F.lit("00")),
                        F.coalesce(fraction, F.lit("")), F.coalesce(zone, F.lit("")))
        iso = _let(text, lambda t: F.when((F.substring(t, 1, 4) != "0000") & F.try_to_timestamp(t).isNotNull(), t))
        return F.coalesce(iso, _named_month(value), F.when(value.isNotNull(), _free_form(value, as_of)))

    return _let(strip(value), common)


def published_instant(text: Column) -> Column:
    """Instant of a canonical date text; text without a zone is read in the session zone."""
    return F.try_to_timestamp(text)
