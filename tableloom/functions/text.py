"""Column functions for cleaning and splitting text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The symbols the text classifier treats as tokens of their own.
SYMBOLS = "!@#$%^&*()[]{};:,./<>?\\|`~-=_+"
# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def symbol_class(symbols: str) -> str:
    """A regular-expression class that matches any one of ``symbols``."""
    return "[" + "".join("\\" + s for s in symbols) + "]"


def isolate_symbols(text: Column, symbols: str = SYMBOLS) -> Column:
    """Put a space on both sides of every symbol."""
    return F.regexp_replace(text, f"({symbol_class(symbols)})", " $1 ")


def blank_symbols(text: Column, symbols: str = SYMBOLS) -> Column:
    """Replace every symbol by one space."""
    return F.translate(text, symbols, " " * len(symbols))


def delete_symbols(text: Column, extra: str = "") -> Column:
    """Delete ASCII punctuation and the characters of ``extra``."""
    return F.translate(text, PUNCTUATION + extra, "")


def words(text: Column) -> Column:
    """Split on single spaces; neighbouring spaces give empty words, which stay."""
    return F.split(text, " ", -1)


def tokens(text: Column) -> Column:
    """The token array of the text classifier."""
    return words(isolate_symbols(text))


def strip(text: Column) -> Column:
    return F.trim(text)


def delete_marks(text: Column, marks: str = "!#?") -> Column:
    return F.translate(text, marks, "")


def title_case(text: Column) -> Column:
    return F.initcap(text)


def clean(text: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """Apply cleaning functions in order."""
    return reduce(lambda value, step: step(value), steps, text)


CLEANING = (strip, delete_marks, title_case)


def count_char(text: Column, char: str) -> Column:
    """How often the one-character string ``char`` occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def to_codes(text: Column) -> Column:
    """Text to an array of code points."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c))


def from_codes(codes: Column) -> Column:
    """Code points, clamped to 1..255, back to text."""
    return F.array_join(
        F.transform(codes, lambda c: F.char(F.least(F.greatest(c, F.lit(1)), F.lit(255)))), ""
    )


def last_number(text: Column) -> Column:
    """The last run of digits as an integer, NULL when there is none."""
    found = F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).try_cast("bigint")


def network_tokens(ip: Column, address: Column, message_id: Column) -> Column:
    """Tokens of a mail log row.

    IP octets, then the labels of the mail domain, then the host labels of the
    message id.  A message id without ``@`` contributes its characters.
    """
    domain = F.get(F.split(address, "@"), F.lit(1))
    host = F.get(F.split(F.get(F.split(message_id, "@"), F.lit(1)), ">"), F.lit(0))
    characters = F.filter(F.split(message_id, ""), lambda c: c != "")
    tail = F.when(F.contains(message_id, F.lit("@")), F.split(host, "[.]")).otherwise(characters)
    return F.concat(F.split(ip, "[.]"), F.split(domain, "[.]"), tail)
