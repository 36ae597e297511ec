"""The format of a column of time stamps, from the evidence of all its values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Day first, month first, year first; with either mark; with seconds, without, or the day alone.
CANDIDATES = tuple(
    f"{day}{clock}" for mark in "/-" for day in (f"d{mark}M{mark}yyyy", f"M{mark}d{mark}yyyy", f"yyyy{mark}M{mark}d") for clock in (" H:m:s[.SSSSSS]", " H:m", "")
)
#: In place of formats: infer the one.
INFER = "infer"


def _shape(pattern: str) -> str:
    """What a text of the format looks like; texts that do not are not parsed, as a failed parse is dear."""
    tokens = {"yyyy": r"\d{4}", "[.SSSSSS]": r"(\.\d{1,6})?"} | dict.fromkeys("dMHms", r"\d{1,2}")
    return "^" + re.sub(r"yyyy|\[\.S+\]|[dMHms]|.", lambda t: tokens.get(t[0]) or re.escape(t[0]), pattern) + "$"


def _read(column: str, pattern: str) -> Column:
    text = F.trim(F.col(f"`{column}`"))
    return F.when(text.rlike(_shape(pattern)), F.try_to_timestamp(text, F.lit(pattern)))


def stamp_evidence(df: DataFrame, column: str, formats: Sequence[str] = CANDIDATES) -> DataFrame:
    """``format, n_texts, n_read``: how many texts of the column there are and how many each format reads. Blank texts and nulls say nothing.

    One aggregation, one row per format. Day and month are told apart by dates that one order makes impossible.
    """
    texts = df.filter(F.trim(F.col(f"`{column}`")) != "")
    found = texts.agg(F.count("*").alias("n_texts"), *[F.count(_read(column, f)).alias(f"n{i}") for i, f in enumerate(formats)])
    rows = [F.struct(F.lit(f).alias("format"), "n_texts", F.col(f"n{i}").alias("n_read")) for i, f in enumerate(formats)]
    return found.select(F.inline(F.array(*rows)))


def inferred_format(df: DataFrame, column: str, formats: Sequence[str] = CANDIDATES) -> str | None:
    """The format that reads every text of the column; None if there is no text. An action.

    No format for all texts is an error, and so are two that read all of them and some of them differently: nothing is guessed from
    the order of the candidates. Of formats that agree on every text the first counts.
    """
    evidence = stamp_evidence(df, column, formats).collect()  # one row per format
    n_texts = evidence[0].n_texts
    if not n_texts:
        return None
    fitting = [e.format for e in evidence if e.n_read == n_texts]
    if not fitting:
        best = max(evidence, key=lambda e: e.n_read)
        raise ValueError(f"no format reads all of {column}: {best.format} reads {best.n_read} of {n_texts} texts")
    first, *others = fitting
    if others:
        differ = [F.count_if(~_read(column, first).eqNullSafe(_read(column, other))) for other in others]
        rivals = [other for other, n in zip(others, df.agg(*differ).first()) if n]
        if rivals:
            raise ValueError(f"{column} may be {' or '.join([first, *rivals])}; name one")
    return first
