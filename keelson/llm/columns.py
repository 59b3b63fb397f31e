"""Small Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space (0x20 and 0x09-0x0D).
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row. Bound as a lambda variable, it
    can be used inside further lambdas without being computed again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: str | Column) -> Column:
    """The text, or an empty string for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space. All white space is turned into
    blanks first, so the split is on a plain character and not by a regular expression."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    some = text.rlike("[" + "".join("\\" + c for c in characters) + "]")
    return F.when(some, F.char_length(text) - F.char_length(F.translate(text, characters, ""))).otherwise(F.lit(0))


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")
