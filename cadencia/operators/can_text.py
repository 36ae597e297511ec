"""Telemetry text: one row of free text to named fields and key/value pairs.

The text starts with a brand, followed by special groups and ``key = value`` parts that are set
apart by two or more blanks. Each special group that is found is cut out of the remainder (one blank
takes its place) before the next one is looked for. That chain of searches is one small Python function over Arrow
batches: as expressions it made methods that the JVM does not compile.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.functions.text import strip, without_bom
from cadencia.schemas import BRANDS

TEXT = "Can Data"
BRAND = "Marca"
PAIRS = "pairs"

# Java's \s lacks the separators 1C to 1F.
_S = r"[\s\x1c-\x1f]"


class Group(NamedTuple):
    anchor: str  # lower-case text without which the pattern cannot match
    pattern: str
    fields: tuple[str, ...]
    kinds: str  # per field: n number, t text, p pressure with unit

    @property
    def texts(self) -> tuple[str, ...]:
        """Names of what the pattern captures: the fields, and the unit of pressures."""
        return (*self.fields, *(["_unit"] if "p" in self.kinds else []))


# Special groups of the telemetry text, in the order in which they are taken out.
_GROUPS = (
    Group(
        "tanque 1 y 2",
        r"Tanque 1 y 2\s*=\s*([\d.]+)\s+y\s+([\d.]+)\s*(kPa)",
        ("Tanque_1_kPa", "Tanque_2_kPa"),
        "pp",
    ),
    Group(
        "temperatura baterias",
        r"Temperatura Baterias\s*=\s*([\d.]+)\s+(\w+)\s*,\s*([\d.]+)\s+(\w+)",
        ("Temp_Bat_Min", "Temp_Bat_Min_Tipo", "Temp_Bat_Max", "Temp_Bat_Max_Tipo"),
        "ntnt",
    ),
    Group(
        "temperatura baterias",
        r"Temperatura Baterias\s*=\s*([\d.]+)\s*([A-Za-z°]+)\s*,",
        ("Temp_Bat", "Temp_Bat_Unidad"),
        "nt",
    ),
    Group(
        "condicion de frenos",
        r"Condicion de Frenos\s*:\s*Del_D\s*=\s*([\d.]+)\s*,\s*Del_I\s*=\s*([\d.]+)\s*,\s*"
        r"Tra_D1\s*=\s*([\d.]+)\s*,\s*Tra_I1\s*=\s*([\d.]+)\s*,\s*"
        r"Tra_D2\s*=\s*([\d.]+)\s*,\s*Tra_I2\s*=\s*([\d.]+)",
        ("Freno_Del_D", "Freno_Del_I", "Freno_Tra_D1", "Freno_Tra_I1", "Freno_Tra_D2", "Freno_Tra_I2"),
        "nnnnnn",
    ),
    Group(
        "alarm",
        r"ALARM\s+Motor\s*=\s*(\w+)\s*,\s*Battery\s*=\s*(\w+)\s*,\s*Air\s*=\s*(\w+)",
        ("ALARM_Motor", "ALARM_Battery", "ALARM_Air"),
        "ttt",
    ),
    Group(
        "alarm",
        r"ALARM\s+Steering\s*=\s*(\w+)\s*,\s*Brake\s*=\s*(\w+)",
        ("ALARM_Steering", "ALARM_Brake"),
        "tt",
    ),
    Group(
        "total fuel usado",
        r",?\s*Horas\s*=\s*([\d.]+)\s*,?\s*Total Fuel usado\s*=\s*([\d.]+)",
        ("Horas", "Total_Fuel_Litros"),
        "nn",
    ),
)
# Brands that begin a text as one word.
KNOWN_BRANDS = ("Yutong", "ADennis", "Volvo", "BYD", "Mercedes", "Scania")

FIELDS = tuple(f for g in _GROUPS for f in g.fields)
_TEXTS = tuple(t for g in _GROUPS for t in g.texts)
_N_TEXTS = len(_TEXTS)
NUMERIC_FIELDS = tuple(f for g in _GROUPS for f, k in zip(g.fields, g.kinds) if k == "n")


def brand_of(text: Column) -> Column:
    """Brand of a raw telemetry text by its prefix; null for no brand, no text or an invalid row."""
    prefix = F.regexp_extract(text, "^(" + "|".join(b.prefix for b in BRANDS) + ")", 1)
    names = F.create_map(*[F.lit(v) for b in BRANDS for v in (b.prefix, b.name)])
    return F.try_element_at(names, prefix)


def valid_rows(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Drop rows that report an error or a listing; rows without text stay."""
    bad = F.col(f"`{text}`").startswith("List") | F.col(f"`{text}`").startswith("Erro")
    return df.filter(~F.coalesce(bad, F.lit(False)))


def branded_rows(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Rows of a known brand with a ``brand`` column; error rows and listings have no brand."""
    tagged = without_bom(df).withColumn("brand", brand_of(F.col(f"`{text}`")))
    return tagged.filter("brand IS NOT NULL")


def squeezed(text: Column) -> Column:
    """Line breaks and tabs to blanks, runs of whitespace to exactly two blanks, trimmed, never null."""

    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\n\r\t]+", " ")
    return strip(F.regexp_replace(plain, rf"(?U){_S}{{2,}}", "  "))


def _float_text(digits: Column) -> Column:
    """Text of digits and points as a number written like 8.1 or 8.0, of any length; null if it is no number."""
    whole = F.regexp_replace(F.substring_index(digits, ".", 1), "^0+(?=.)", "")
    part = F.regexp_replace(F.regexp_replace(digits, r"^[0-9]*\.?", ""), "0+$", "")
    text = F.concat(F.when(whole == "", "0").otherwise(whole), F.lit("."), F.when(part == "", "0").otherwise(part))
    written_so = digits.rlike(r"^(0|[1-9][0-9]*)\.(0|[0-9]*[1-9])$")
    return F.when(written_so, digits).when(digits.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), text)


def _word_class() -> str:
    r"""The SQL engine's Unicode ``\w`` as a class: letters, marks, decimal digits, connectors, joiners, letters in circles and squares."""
    kinds = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Nd", "Mn", "Mc", "Me", "Pc"}
    codes = {c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in kinds}
    codes |= {0x200C, 0x200D, *range(0x24B6, 0x24EA), *range(0x1F130, 0x1F14A), *range(0x1F150, 0x1F16A), *range(0x1F170, 0x1F18A)}
    starts, ends = ([c for c in sorted(codes) if c + step not in codes] for step in (-1, 1))
    return "[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends)) + "]"


@functools.cache
def _compiled(latin: bool) -> list[tuple[str, re.Pattern, int, int]]:
    """Per group: anchor, pattern, where its texts go, and how many there are. In Latin-1 Python's ``\\w`` has some numerals more."""
    word = r"[^\W\xb2\xb3\xb9\xbc-\xbe]" if latin else _word_class()
    groups, at = [], 0
    for group in _GROUPS:
        groups.append((group.anchor, re.compile(group.pattern.replace(r"\w", word), re.IGNORECASE), at, at + len(group.texts)))
        at += len(group.texts)
    return groups


_BREAKS = re.compile(r"[\n\r\t]+")
_WIDE = re.compile(r"\s{2,}")
_LETTER = re.compile("[a-zA-Z]")


def _tidy(part: str) -> str:
    return part.strip().strip(",").strip()


def _parse(text: str) -> tuple[str, list[str | None], dict[str, str]]:
    """Brand, what the groups capture, and the ``key = value`` parts; of repeated keys the last one stays."""
    if not text.isascii():
        try:
            text.encode("latin-1")
            latin = True
        except UnicodeEncodeError:
            latin = False
    else:
        latin = True
    plain = _WIDE.sub("  ", _BREAKS.sub(" ", text)).strip()
    word = plain.split(None, 1)[0] if plain else ""
    if word in KNOWN_BRANDS:
        brand, rest = word, plain[len(word) :].strip()
    else:
        brand, _, rest = plain.partition("  ")
        brand = brand.strip()
    captured: list[str | None] = [None] * _N_TEXTS
    low = rest.lower()
    for anchor, pattern, begin, end in _compiled(latin):
        if anchor in low and (hit := pattern.search(rest)):
            captured[begin:end] = hit.groups()
            # One blank takes the place of what was found.
            rest = f"{rest[: hit.start()]} {rest[hit.end() :]}"
            low = rest.lower()
    pairs: dict[str, str] = {}
    for part in rest.split("  "):
        if "=" in part:
            part = _tidy(part)
            key, _, value = part.partition("=")
            if (key := _tidy(key)) and _LETTER.search(part):
                pairs.pop(key, None)
                pairs[key] = _tidy(value)
    return brand, captured, pairs


@functools.cache
def _parser():
    """The parse as a function of columns; the texts of a batch go in, a struct of texts and a map comes out."""
    names = ["brand", *_TEXTS]
    pairs_type = T.MapType(T.StringType(), T.StringType())
    result = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(PAIRS, pairs_type)])

    def parse(texts: pa.Array) -> pa.Array:
        brands, rows, sizes, keys, values = [], [], [0], [], []
        for text in texts.to_pylist():
            brand, captured, pairs = _parse(text)
            brands.append(brand)
            rows.append(captured)
            keys += pairs
            values += pairs.values()
            sizes.append(len(keys))
        columns = [pa.array(c, pa.string()) for c in (brands, *(zip(*rows) if rows else [()] * _N_TEXTS))]
        entries = pa.MapArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
        return pa.StructArray.from_arrays([*columns, entries], names=[*names, PAIRS])

    # Named more than once by what reads it, so the optimizer must not write it out again, which would parse again.
    return F.arrow_udf(parse, result).asNondeterministic()


def parse_can(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Replace the text column by ``Marca``, the fixed fields and a ``pairs`` map.

    A key in ``pairs`` may have the name of a fixed field; ``can_wide`` lets it win.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != text]
    whole = F.make_valid_utf8(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    steps = df.select(*kept, _parser()(whole).alias("_parsed"))
    part = lambda name: F.col(f"_parsed.{name}")
    fields = []
    for group in _GROUPS:
        for name, kind in zip(group.fields, group.kinds):
            col = part(name)
            if kind == "n":
                col = col.try_cast("double")
            elif kind == "p":
                # Null if the number is unreadable, e.g. 1..2.
                col = F.concat(_float_text(col), F.lit(" "), part(group.texts[-1]))
            fields.append(col.alias(name))
    return steps.select(*kept, part("brand").alias(BRAND), *fields, part(PAIRS).alias(PAIRS))


def brand_counts(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Rows per configured brand, 0 for a brand without rows."""
    spark = df.sparkSession
    brands = spark.createDataFrame([(b.name,) for b in BRANDS], "brand string")
    counted = branded_rows(df, text).groupBy("brand").agg(F.count("*").alias("n"))
    # At most one row per configured brand on either side.
    return brands.join(F.broadcast(counted), "brand", "left").select(
        "brand", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows")
    )
