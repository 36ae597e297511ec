"""Text: missing-value tokens, whitespace, column names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that count as missing in the raw reports.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Code points that count as whitespace in the telemetry text.
_BLANK_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
BLANKS = "".join(map(chr, _BLANK_CODES))

_ACCENTED = "áéíóúüñÁÉÍÓÚÜÑ"
_PLAIN = "aeiouunAEIOUUN"


def null_if_na(col: Column) -> Column:
    return F.when(~col.isin(*NA_TOKENS), col)


def strip(col: Column, extra: str = "") -> Column:
    """Trim Unicode whitespace (plus ``extra`` characters) on both ends."""
    return F.btrim(col, F.lit(BLANKS + extra))


def strip_accents(col: Column) -> Column:
    """Accents off for Spanish letters."""
    return F.translate(col, _ACCENTED, _PLAIN)


def warehouse_name(name: str) -> str:
    """Column name of upper-case ASCII letters, digits and ``_``; other runs are one ``_``; no digit comes first."""
    out: list[str] = []
    for ch in unicodedata.normalize("NFKD", name):
        for c in ch.upper():
            if c.isascii() and (c.isalnum() or c == "_"):
                out.append(c)
            elif not unicodedata.combining(c) and (not out or out[-1] != "\0"):
                out.append("\0")  # the place of one or more other characters
    text = "".join(out).replace("\0", "_")
    return "_" + text if text and text[0] in "0123456789" else text


def with_warehouse_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[warehouse_name(c) for c in df.columns])


def without_bom(df: DataFrame) -> DataFrame:
    """A byte-order mark can stick to the first header, decoded as UTF-8 or as Latin-1."""
    return df.toDF(*[re.sub("^(\ufeff|\u00ef\u00bb\u00bf)", "", c) for c in df.columns])
