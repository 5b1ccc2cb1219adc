"""White space, line and word rules shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six ASCII white-space characters, 0x20 and 0x09 to 0x0D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"\x20\x09-\x0D"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: For ``bytes.translate``: A-Z to a-z, all else as it is. ``bytes.split()`` without
#: arguments splits at exactly the characters of ``WHITE``.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def filled(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words (runs of other than white space); null counts 0."""
    return F.regexp_count(filled(text), F.lit(f"[^{WHITE_CLASS}]+")).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; letters beyond ASCII stay as they are."""
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
