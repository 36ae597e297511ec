"""Benchmark decontamination by winnowing, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadencia.llm.common import ascii_lower, text_key
from cadencia.session import materialize

#: Separators between words, of texts whose A-Z are lowered.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lowered text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _grams(hashes: Column, k: int) -> Column:
    """Hash of every k consecutive word hashes."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - F.lit(k - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, k)]) if k > 1 else x,
    )


def _shifted_minima(values: Column, step: int) -> Column:
    """Minimum of every value and the one ``step`` places on."""
    return F.transform(
        F.slice(values, 1, F.greatest(F.size(values) - F.lit(step), F.lit(0))),
        lambda x, i: F.least(x, F.get(values, i + step)),
    )


def with_minima(df: DataFrame, length: int) -> DataFrame:
    """Adds ``m<length>``: for every window of ``length`` words the smallest hash of its k-grams, its fingerprint.

    Each step is a projection of its own; nested in one expression, arrays would be computed again for every element.
    """
    k, name = min(GRAM, length), f"m{length}"
    df = df.withColumn(name, _grams(F.col("hashes"), k))
    width, have = length - k + 1, 1
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(name, _shifted_minima(F.col(name), step))
        have += step
    return df


def _hashed(df: DataFrame, text_col: str, lengths: list[int]) -> DataFrame:
    df = df.withColumn("words", words(F.col(text_col))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for n in lengths:
        df = with_minima(df, n)
    return df


def _prints(minima: Column, length: int) -> Column:
    return F.transform(F.array_distinct(minima), lambda m: F.struct(F.lit(length).alias("len"), m.alias("print")))


def _windows(tokens: Column, minima: Column, length: int) -> Column:
    return F.transform(
        minima,
        lambda m, i: F.struct(
            i.alias("start"), F.lit(length).alias("len"), m.alias("print"),
            F.array_join(F.slice(tokens, i + 1, F.lit(length)), " ").alias("window"),
        ),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = 13, share: int = 20, with_key: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A window is ``window`` consecutive words of a benchmark item; an item of fewer, but not none, is one window. Words
    of a document inside an occurrence of a window are hit. A document is contaminated if any word is hit and hits are at
    least one in ``share`` words. Null, empty and wordless texts have no words and no hits; wordless
    items have no windows; an item that repeats counts once. Rows of one id are separate documents; rows of equal
    id and text get equal results. An empty benchmark hits nothing. Other columns are not read. ``with_key`` adds ``tk``,
    the ``text_key`` of the row's text.

    Winnowing: each window is represented by its smallest k-gram hash, so a shared window always shares
    a fingerprint. Different fingerprints of the documents are written once, joined with those of the benchmark,
    and only documents with a common fingerprint are read again: their windows with such a fingerprint are compared
    word by word, which extends the hits. Every join is left to Spark, which broadcasts a side only when the size
    it has measured on the written table is under its threshold.
    """
    items = materialize(
        benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("len", F.least(F.size("words"), F.lit(window))),
        "decontam-items",
    )
    lengths = sorted(r.len for r in items.select("len").distinct().collect())  # between 1 and `window`
    parts = [
        with_minima(items.filter(F.col("len") == n), n).select("item_id", F.explode(_windows(F.col("words"), F.col(f"m{n}"), n)).alias("w"))
        for n in lengths
    ] or [items.select("item_id", F.explode(F.array().cast("array<struct<start:int,len:int,print:bigint,window:string>>")).alias("w"))]
    wanted = parts[0]
    for part in parts[1:]:
        wanted = wanted.unionByName(part)
    wanted = materialize(wanted.select("item_id", "w.len", "w.print", "w.window").distinct(), "decontam-windows")

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("tk", text_key(F.col("text")))
    hashed = _hashed(source, "text", lengths)
    prints = [_prints(F.col(f"m{n}"), n) for n in lengths]
    printed = materialize(
        hashed.select(
            "doc_id", "tk", F.size("words").cast("long").alias("n_words"),
            (F.concat(*prints) if prints else F.array().cast("array<struct<len:int,print:bigint>>")).alias("prints"),
        ),
        "decontam-prints",
    )
    common = materialize(
        printed.select("doc_id", "tk", F.explode("prints").alias("p")).select("doc_id", "tk", "p.len", "p.print")
        .join(wanted.select("len", "print").distinct(), ["len", "print"], "left_semi")
        .groupBy("doc_id", "tk").agg(F.collect_set(F.struct("len", "print")).alias("common")),
        "decontam-common",
    )
    same = source["doc_id"].eqNullSafe(common["doc_id"]) & (source["tk"] == common["tk"])
    near = source.join(common, same).select(source["doc_id"], source["tk"], "text", "common")
    near = _hashed(near, "text", lengths)
    hits = [
        F.filter(
            _windows(F.col("words"), F.col(f"m{n}"), n),
            lambda w: F.array_contains("common", F.struct(w["len"].alias("len"), w["print"].alias("print"))),
        )
        for n in lengths
    ]
    extended = near.select("doc_id", "tk", F.explode(F.concat(*hits)).alias("w")) if hits else None
    if extended is None:
        found = printed.select("doc_id", "tk", F.array().cast("array<struct<start:int,len:int>>").alias("spans"), F.array().cast("array<string>").alias("items")).limit(0)
    else:
        found = (
            extended.select("doc_id", "tk", "w.start", "w.len", "w.window").join(wanted.select("window", "item_id"), "window")
            .groupBy("doc_id", "tk")
            .agg(
                F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"),
                F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
            )
        )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    found = found.select(
        F.col("doc_id").alias("d"), F.col("tk").alias("t"), covered.alias("hit"), F.size("items").cast("long").alias("items"),
        F.sha2(F.array_join("items", ","), 256).alias("sha"),
    )
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return printed.drop("prints").join(found, printed["doc_id"].eqNullSafe(F.col("d")) & (printed["tk"] == F.col("t")), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), *(["tk"] if with_key else []),
    )
