"""Contiguous shards of near-equal bytes from global prefix sums, in Spark expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadencia.llm.common import ordered_parts, running_totals
from cadencia.session import materialize

_ORDER = ("digest", "doc_id", "size")
_NO_ID = -(1 << 63)


def _at_or_after(digest: bytes, doc_id: int | None) -> Column:
    """Rows at or after a cut; without an id the cut lies before all rows of the digest."""
    at = F.col("digest") > F.lit(bytearray(digest))
    same = F.col("digest") == F.lit(bytearray(digest))
    return at | same if doc_id is None else at | (same & (F.coalesce("doc_id", F.lit(_NO_ID)) >= doc_id))


def _free_names(columns: list[str], taken: tuple[str, ...]) -> list[str]:
    """``columns``, those named like one of ``taken`` with as many prefixes ``document_`` as make them unlike all others."""
    used, names = {c.lower() for c in (*taken, *columns)}, []
    for name in columns:
        if name.lower() in taken:
            while name.lower() in used:
                name = f"document_{name}"
            used.add(name.lower())
        names.append(name)
    return names


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    With ``whole`` these follow the columns of ``docs``, so that a shard holds its documents; a column of ``docs`` that has the name of
    one of the others but ``doc_id`` is then called ``document_<name>``.

    ``size`` is the text's UTF-8 bytes plus 1 (null has none); the law is ``bytes``. Rows are ordered by (MD5 of the
    text, id), a fixed shuffle of the corpus in which equal texts are neighbours, and cut where the running
    total of sizes passes each multiple of total / ``shards``. A cut inside a group of equal texts moves to the nearer
    end of the group, so equal texts stay together, unless the group is larger than a shard's target: such
    a group cannot fit in one and is cut inside. ``slot`` numbers a shard's rows from 0. ``grown_shard`` belongs to
    another law and is null. Null and empty texts are one group. Rows that repeat an id and a text are kept and numbered; they
    may come in either order. Fewer rows than shards leave shards empty; an empty table gives an empty result.

    Narrow rows (``whole``: all of each row, shuffled this once) are range-partitioned and written; one total per partition gives every partition its offset, and
    rows are summed inside their partition. The cuts, at most ``shards - 1`` rows, are the only thing collected.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("digest"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []),
    )
    order = [F.col("digest"), F.col("doc_id").asc_nulls_first(), F.col("size")]
    parts = materialize(ordered_parts(narrow, *order), "shard-rows")
    total = parts.agg(F.sum("size")).first()[0] or 0
    placed = running_totals(parts, order, bytes_before=F.col("size"), rows_before=F.lit(1))

    # Cut k lies in the row that holds byte number ceil(k * total / shards).
    passed = lambda byte: F.expr(f"({byte}) * {shards} div {max(total, 1)}")
    cutting = (
        placed.withColumn("first_cut", F.when(F.col("bytes_before") == 0, F.lit(1)).otherwise(passed("bytes_before - 1") + 1))
        .withColumn("last_cut", F.least(passed("bytes_before + size - 1"), F.lit(shards - 1)))
        .filter("first_cut <= last_cut")
        .select("digest", "doc_id", F.explode(F.sequence("first_cut", "last_cut")).alias("k"))
    )
    cuts = {r.k: r for r in cutting.collect()}
    digests = list({bytes(r.digest) for r in cuts.values()})
    groups = {
        bytes(r.digest): r
        for r in placed.filter(F.col("digest").isin(*[bytearray(d) for d in digests])).groupBy("digest")
        .agg(F.min("bytes_before").alias("begin"), F.max(F.col("bytes_before") + F.col("size")).alias("end")).collect()
    } if digests else {}
    bounds: list[Column] = []
    for k in range(1, shards):
        if k not in cuts:
            continue
        row, group = cuts[k], groups[bytes(cuts[k].digest)]
        if (group.end - group.begin) * shards > total:
            bounds.append(_at_or_after(bytes(row.digest), _NO_ID if row.doc_id is None else row.doc_id))
        elif 2 * k * total <= (group.begin + group.end) * shards:
            bounds.append(_at_or_after(bytes(row.digest), None))
        else:
            bounds.append(F.col("digest") > F.lit(bytearray(bytes(row.digest))))
    number = reduce(lambda a, b: a + b, [b.cast("int") for b in bounds], F.lit(0))
    placed = placed.withColumn("shard", number)
    begins = placed.groupBy("shard").agg(F.min("rows_before").alias("begin"))
    own = placed.join(begins, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rows_before") - F.col("begin")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *(["row"] if whole else []),
    )
    if not whole:
        return own
    added = [c for c in own.columns if c not in ("doc_id", "row")]
    names = _free_names(docs.columns, tuple(added))
    return own.select(*[F.col("row")[c].alias(n) for c, n in zip(docs.columns, names)], *added)
