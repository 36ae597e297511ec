"""Parity audit over pairs of tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cadencia.operators.audit import compare_schemas, narrowed, narrowed_report, narrowed_summary
from cadencia.operators.ranges import date_filter
from cadencia.plans.store import quoted
from cadencia.sources.sinks import dump_discrepancies

IDENTICAL, DIFFERENT, FAULT = 0, 1, 2


class Pair(NamedTuple):
    name: str
    left: str
    right: str


class Report(NamedTuple):
    name: str
    code: int
    messages: list[str]
    summary: dict[str, int]
    dump: str | None = None


def compare_frames(
    left: DataFrame, right: DataFrame, cutoff: str, until: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides under the same date filter, the right one in the left one's column order."""
    a, b = date_filter(left, cutoff, until), date_filter(right, cutoff, until)
    return a, b.select(*[f"`{c}`" for c in a.columns])


def audit_frames(
    name: str, left: DataFrame, right: DataFrame, cutoff: str, until: str | None = None,
    out_dir: str | None = None, dump_limit: int | None = None,
) -> Report:
    """Schemas first, then a fingerprint per day, then the rows of the days that differ; ``out_dir`` receives the differing rows.

    All of them, unless the caller names a ``dump_limit``; a message then says how many of how many were written.
    """
    date.fromisoformat(cutoff)
    if until:
        date.fromisoformat(until)
    verdict = compare_schemas(left.schema, right.schema)
    if not verdict.same:
        return Report(name, FAULT, verdict.messages, {})
    left, right = compare_frames(left, right, cutoff, until)
    day = next((c for c in left.columns if c.upper() == "FECHA"), None)
    summary, rows = narrowed_report(left, right, day) if out_dir else (narrowed_summary(narrowed(left, right, day)), None)
    if not summary["only_left_rows"] + summary["only_right_rows"]:
        return Report(name, IDENTICAL, verdict.messages, summary)
    dump, messages = None, [*verdict.messages]
    if rows is not None:
        dump = f"{out_dir.rstrip('/')}/discrepancies_{name}"
        found = rows.count()
        if dump_limit is not None and found > dump_limit:
            rows = rows.orderBy(*[f"`{c}`" for c in rows.columns if c != "side"], "side").limit(dump_limit)
            messages.append(f"the limit was reached: {dump_limit} of {found} differing rows were written")
        else:
            messages.append(f"{found} differing rows were written")
        dump_discrepancies(rows, dump)
    return Report(name, DIFFERENT, messages, summary, dump)


def audit_pair(spark: SparkSession, pair: Pair, cutoff: str, **options) -> Report:
    """Compare two catalog tables; a missing one is a fault of this pair only."""
    for table in (pair.left, pair.right):
        if not spark.catalog.tableExists(table):
            return Report(pair.name, FAULT, [f"{table} does not exist"], {})
    left, right = spark.table(quoted(pair.left)), spark.table(quoted(pair.right))
    return audit_frames(pair.name, left, right, cutoff, **options)


def audit(
    spark: SparkSession, pairs: Sequence[Pair], cutoff: str, **options
) -> tuple[int, list[Report]]:
    """All pairs; the code is the worst one: 0 identical, 1 different, 2 fault."""
    reports = [audit_pair(spark, p, cutoff, **options) for p in pairs]
    return max((r.code for r in reports), default=IDENTICAL), reports
