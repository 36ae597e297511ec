"""Lines that many documents share, found with two Bloom filters and confirmed exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm import bloom
from cadencia.llm.common import BLANKS, as_bytes, bounded_batches
from cadencia.session import materialize


def _keys(text: bytes) -> list[bytes]:
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]  # bytes.lower lowers A-Z only


def _first_lines(text: bytes, min_chars: int) -> tuple[list[bytes], list[int]]:
    """Digest (16 bytes) and first line number of each different key that is long enough."""
    seen: dict[bytes, int] = {}
    for i, key in enumerate(_keys(text)):
        if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
            seen.setdefault(xxhash.xxh3_128_digest(key), i)
    return list(seen), list(seen.values())


def _short(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2]


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, max_bits: int = bloom.MAX_BITS,
) -> DataFrame:
    """One row per input row: ``doc_id, text, n_lines, n_dropped, kept_sha256`` (``text`` without the dropped lines).

    A text is split at ``\\n``; null and empty are one empty line. A line's key is the line with
    ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lowered. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` rows of ``docs`` lose their lines everywhere (with ``keep_first`` all but the first line of the
    smallest id). Every row counts as a document, also if its id or text repeats. Other columns are not read.

    First pass: each document's different keys go into the filters. Second pass: only keys that the ``twice`` filter
    knows are shuffled, as 16-byte digests, and counted exactly; counts combine before the shuffle, so a line
    of every document is one row per task. The confirmed keys are joined back to the suspects (an exchange that AQE
    can split) and each document gets the list of its dropped keys.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The identity of a row for the joins below; rows with equal id and text have equal results.
    source = source.withColumn("tk", F.xxhash64(F.coalesce("text", F.lit("")), F.octet_length("text")))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes] = []
            for text in as_bytes(batch.column(0)):
                digests += _first_lines(text or b"", min_chars)[0]
            yield pa.RecordBatch.from_arrays([pa.array(_short(digests).view(np.int64))], names=["h"])

    # A text of n bytes has at most n + 1 lines; the filter is sized by the lines there are.
    n_lines = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col)) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))), F.lit(0)) + 1)).first()[0] or 0
    twice = spark.sparkContext.broadcast(
        bloom.twice_filter(source.select("text").mapInArrow(hashes, "h long"), bloom.bits_for(n_lines, max_bits)),
    )

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, lines = [], [], []
            for r, text in enumerate(as_bytes(batch.column(1))):
                digests, numbers = _first_lines(text or b"", min_chars)
                if digests:
                    for i in np.flatnonzero(bloom.contains(twice.value, _short(digests))):
                        rows.append(r)
                        keys.append(digests[i])
                        lines.append(numbers[i])
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(2), pa.array(keys, pa.binary()), pa.array(lines, pa.int32())],
                names=["doc_id", "tk", "key", "line"],
            )

    id_field = source.schema["doc_id"]
    found = materialize(
        source.mapInArrow(
            suspects,
            T.StructType([id_field, T.StructField("tk", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("line", T.IntegerType())]),
        ),
        "line-suspects",
    )
    first = F.min(F.struct("doc_id", "tk", "line")).alias("first")
    confirmed = materialize(
        found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first).filter(F.col("n") >= min_docs).select("key", "first"),
        "line-keys",
    )
    dropped = (
        found.join(confirmed, "key")
        .withColumn("stays", F.lit(keep_first) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tk") == F.col("first.tk")))
        .groupBy("doc_id", "tk")
        .agg(F.collect_set(F.struct("key", "stays")).alias("keys"))
        .select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), "keys")
    )
    joined = source.join(dropped, source["doc_id"].eqNullSafe(F.col("d")) & (source["tk"] == F.col("t")), "left").select(
        "doc_id", "text", F.col("keys.key").alias("keys"), F.col("keys.stays").alias("stays"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for text, keys, stays in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines = (text or b"").split(b"\n")
                n = len(lines)
                if keys:
                    left = dict(zip(keys, stays))
                    kept = []
                    for line, key in zip(lines, _keys(text)):
                        digest = xxhash.xxh3_128_digest(key)
                        if digest not in left:
                            kept.append(line)
                        elif left[digest]:
                            left[digest] = False
                            kept.append(line)
                    lines = kept
                rest = b"\n".join(lines)
                for column, value in zip(out, (rest, n, n - len(lines), hashlib.sha256(rest).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.binary()).cast(pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                names=["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.mapInArrow(
        cut,
        T.StructType([
            id_field, T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        ]),
    )
