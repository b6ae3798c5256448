"""Text helpers that keep Python's idea of white space on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters str.strip() removes, as one string and as the body of a regex class.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
          "        　")
WS = r"\t-\r\x1c-\x20\x85\xa0  -     　"

# End of text as Python's `$` sees it: the very end, or before one last newline.
END = r"\n?\z"


def strip(text: Column) -> Column:
    """Trim both ends by Python's white space (Spark's own trim only knows the blank)."""
    return F.btrim(text, F.lit(SPACES))


def any_of(text: Column, patterns: list[str]) -> Column:
    """True when one of the patterns is found anywhere, in any case."""
    return text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns))


def attr(name: str, attrs: str = "attrs") -> Column:
    return F.try_element_at(F.col(attrs), F.lit(name))
