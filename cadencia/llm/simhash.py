"""Near duplicates by SimHash: block keys bring fingerprints together, pivot distance tables discard most pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import as_bytes, bounded_batches
from cadencia.llm.components import components
from cadencia.session import materialize

SEED = 42
#: Reference fingerprints (pivots): XXH64 of their number.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16)], np.uint64)


def fingerprint(text: bytes, words: int) -> int:
    """Bits set in over half the XXH64 hashes of the text's word shingles, repeats included; 0 without words."""
    tokens = text.lower().split()  # of bytes: A-Z only, and exactly [\x20\x09-\x0D]
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    begins = np.concatenate(([0], ends[:-words] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends[words - 1 :].tolist())], np.uint64, len(begins),
    )
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _blocks(max_bits: int) -> tuple[list[int], int, int]:
    """Widths of the blocks of a fingerprint, and how many of them two linked fingerprints share at least."""
    n = max_bits + 3
    return [64 * (i + 1) // n - 64 * i // n for i in range(n)], n, n - max_bits


def block_keys(max_bits: int):
    """(key, fp) rows: a key for every choice of blocks that fingerprints at ``max_bits`` or fewer bits may share."""
    widths, n, shared = _blocks(max_bits)
    shifts = np.cumsum([0, *widths[:-1]])
    masks = []
    for chosen in combinations(range(n), shared):
        masks.append(np.uint64(sum(((1 << widths[i]) - 1) << int(shifts[i]) for i in chosen)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for number, mask in enumerate(masks):
                with np.errstate(over="ignore"):
                    key = ((fps & mask) ^ np.uint64(number + 1)) * np.uint64(0x9E3779B97F4A7C15)
                    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(number)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fps.view(np.int64))], names=["key", "fp"])

    return run


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among different fingerprints.

    Each fingerprint is compared once with those not reached yet. A table of distances to the pivots is
    built first; by the triangle inequality, a pair whose distances to any pivot differ by more than
    ``max_bits`` cannot be linked. The rest is verified bit by bit. Memory is one row per fingerprint.
    """
    if len(fps) == 2:
        return [(0, 1)] if int(np.bitwise_count(fps[0] ^ fps[1])) <= max_bits else []
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")  # by the first pivot: a window of it bounds the candidates
    left, edges = order, []
    first = table[left, 0]
    while len(left):
        at = int(left[0])
        left, first = left[1:], first[1:]
        queue = [at]
        while queue and len(left):
            x = queue.pop()
            low, high = np.searchsorted(first, [table[x, 0] - max_bits, table[x, 0] + max_bits + 1])
            near = np.arange(low, high)
            for pivot in range(1, len(PIVOTS)):
                if not len(near):
                    break
                near = near[np.abs(table[left[near], pivot] - table[x, pivot]) <= max_bits]
            if len(near):
                near = near[np.bitwise_count(fps[left[near]] ^ fps[x]) <= max_bits]
            if len(near):
                reached = left[near]
                edges += [(at, int(y)) for y in reached]
                queue += reached.tolist()
                keep = np.ones(len(left), bool)
                keep[near] = False
                left, first = left[keep], first[keep]
    return edges


def links_in_blocks(max_bits: int):
    """Over rows sorted by key: spanning links of every key's fingerprints. Keys may cross batches."""

    def flush(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ends = np.append(starts[1:], len(keys))
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > 1:
                group = fps[s:e]
                for x, y in _forest(group, max_bits):
                    a.append(group[x])
                    b.append(group[y])
        pair = [np.array(x, np.uint64).view(np.int64) for x in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(*pair)), pa.array(np.maximum(*pair))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("key").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = int(np.searchsorted(k, k[-1]))  # rows of the last key wait for the next batch
            if cut or (held_k and held_k[-1][-1] != k[0]):
                yield flush(np.concatenate([*held_k, k[:cut]]), np.concatenate([*held_f, f[:cut]]))
                held_k, held_f = [k[cut:]], [f[cut:]]
            else:
                held_k.append(k)
                held_f.append(f)
        if held_k:
            yield flush(np.concatenate(held_k), np.concatenate(held_f))

    return run


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) for every row, written once."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or b"", words) for t in as_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return materialize(
        source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])), "simhash",
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4,
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` after lowering A-Z; shingles are ``words`` of them. Fewer words are one
    shingle; no words (null, empty or blank texts) are fingerprint zero, linked like any other. Fingerprints at
    ``max_bits`` or fewer differing bits are linked; ``component_id`` is the smallest id reachable (null ids, if any,
    are smaller than all). Rows that repeat get the same result each. Other columns are not read.

    Only different fingerprints are compared. A fingerprint is cut into ``max_bits + 3`` blocks; linked ones share
    at least three, so each is dealt out under every choice of three blocks. Inside one key, pivot distance tables
    discard pairs and a search emits spanning links only, never all pairs; no link is lost.
    """
    fps = simhash(docs, id_col, text_col, words)
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count_if(F.col("doc_id").isNull()).alias("nulls")), "simhash-nodes")
    dealt = nodes.select("fp").mapInArrow(block_keys(max_bits), "key long, fp long")
    links = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(links_in_blocks(max_bits), "a long, b long")
    roots = components(materialize(links.distinct(), "simhash-links"))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted.select("fp", "root", "doc_id", "nulls"), "simhash-roots")
    smallest = rooted.groupBy("root").agg(
        F.when(F.sum("nulls") == 0, F.min("doc_id")).alias("component_id"),
    )
    by_fp = materialize(rooted.join(smallest, "root").select(F.col("fp").alias("f"), "component_id"), "simhash-components")
    return fps.join(by_fp, F.col("fp") == F.col("f")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )
