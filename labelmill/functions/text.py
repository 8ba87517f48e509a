"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that Python's str.strip removes.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# Cell texts that count as missing, compared after stripping, case-sensitively.
NULL_TOKENS = ("", "nan", "None")

# Cell texts a spreadsheet or CSV reader turns into missing cells by default.
READER_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "",
)


def strip_text(col: Column) -> Column:
    """Cast to string and strip Unicode whitespace at both ends.

    Booleans and large doubles take Spark's spelling (``true``, ``1.0E20``). ``btrim`` with a
    character set indexes every character of the text, so it is left to texts that need it.
    """
    text = col.cast("string")
    blank_end = F.left(text, F.lit(1)).isin(*WHITESPACE) | F.right(text, F.lit(1)).isin(*WHITESPACE)
    return F.when(blank_end, F.btrim(text, F.lit(WHITESPACE))).otherwise(text)


def null_if_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL where the whole value is one of ``tokens``."""
    return F.when(~col.isin(*tokens), col)


def text_key(col: Column) -> Column:
    """Fixed-width stand-in for a text in shuffles and cache keys."""
    return F.sha2(col, 256)


def tokens(col: Column) -> Column:
    """Lower-cased tokens between single spaces, empties dropped, repeats kept."""
    return F.filter(F.split(F.lower(col), " "), lambda t: t != "")
