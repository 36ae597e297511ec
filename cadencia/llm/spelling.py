"""Spelling variants: edits of a word are looked up in Bloom filters of the vocabulary, what they know is joined exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadencia.llm.common import ascii_lower
from cadencia.session import materialize

RUN = "[a-zÀ-ÿ]"
#: Words of so many code points and more share one shard.
LONGEST_SHARD = 64
BITS_PER_WORD = 16
PROBES = 5
#: Filters broadcast at once, in blocks of 64 bytes; a vocabulary that needs more is gone through in several rounds.
ROUND_BLOCKS = 1 << 19
#: Blocks of a filter that one group builds, about 32,000 words.
SEGMENT_BLOCKS = 1 << 10
#: Edits looked up together.
EDITS = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_ODD, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the words of one length, and their code points plus 1 as a matrix."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == size)
        step = max(1, EDITS // size)
        for at in range(0, len(which), step):
            some = which[at : at + step]
            data = "".join([words[i] for i in some.tolist()]).encode("utf-32-le")
            yield some, np.frombuffer(data, np.uint32).reshape(len(some), size).astype(np.uint64) + np.uint64(1)


def word_hashes(words: list[str]) -> np.ndarray:
    """The mixed sum of code point * odd^position: sums of edited words follow from it without spelling them out."""
    out = np.zeros(len(words), np.uint64)
    for which, codes in _by_length(words):
        out[which] = _mixed((codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64))
    return out


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row, hash) of words near those in the matrix ``codes``: every deletion, and every replacement by a greater letter.

    Of two near words the longer one or, at equal length, the one with the smaller letter finds the other.
    """
    n, size = codes.shape
    power = _powers(size)
    terms = codes * power
    before = np.zeros((n, size + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1]
    # Deleting any letter of a run of equal ones gives the same word: the last one stands for them.
    last = np.ones((n, size), bool)
    last[:, :-1] = codes[:, :-1] != codes[:, 1:]
    shorter = before[:, :-1] + (whole[:, None] - before[:, 1:]) * _INVERSE
    row, at = np.nonzero(last)
    yield size - 1, row, _mixed(shorter[row, at])
    letters = alphabet.astype(np.uint64) + np.uint64(1)
    step = max(1, EDITS // max(1, n * len(letters)))
    for start in range(0, size, step):
        here = codes[:, start : start + step]
        sums = whole[:, None, None] + (letters - here[:, :, None]) * power[None, start : start + step, None]
        row, at, letter = np.nonzero(letters > here[:, :, None])
        yield size, row, _mixed(sums[row, at, letter])


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Block of each hash and the bits it sets there: all in one block of 512."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    x = (hashes & np.uint64(0xFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
    return block.astype(np.int64), [((x >> np.uint64(19 + 9 * i)) & np.uint64(511)).astype(np.int64) for i in range(PROBES)]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which part of a shard too large for one round a hash is in."""
    return (_mixed(hashes ^ np.uint64(_ODD)) % np.uint64(parts)).astype(np.int64)


def known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter ``bits`` (blocks of 64 bytes) may hold."""
    block, at = _bits(hashes, len(bits) // 64)
    found = np.ones(len(hashes), bool)
    for bit in at:
        found &= (bits[block * 64 + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1
    return found


def plan_rounds(words: dict[int, int], round_blocks: int) -> list[dict[tuple[int, int], tuple[int, int]]]:
    """Rounds of filters from the number of words per shard: (shard, part) -> (parts of the shard, blocks)."""
    rounds: list[dict[tuple[int, int], tuple[int, int]]] = []
    room = 0
    for shard, n in sorted(words.items()):
        blocks = n * BITS_PER_WORD // 512 + 1
        parts = -(-blocks // round_blocks)
        each = -(-blocks // parts)
        for part in range(parts):
            if each > room:
                rounds.append({})
                room = round_blocks
            rounds[-1][shard, part] = (parts, each)
            room -= each
    return rounds


def _filters(keyed: DataFrame, plan: dict[tuple[int, int], tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The filters of a round. A group of words builds one segment of one filter; at most ``ROUND_BLOCKS`` blocks reach the driver."""
    shards = {shard: parts for (shard, _), (parts, _) in plan.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            shard = batch.column(1).to_numpy(zero_copy_only=False)
            for s, parts in shards.items():
                mine = h[shard == s]
                part = part_of(mine, parts)
                for p in np.unique(part).tolist():
                    if (s, p) in plan:
                        some = mine[part == p]
                        block = _bits(some, plan[s, p][1])[0]
                        columns = [np.full(len(some), s), np.full(len(some), p), block // SEGMENT_BLOCKS, some.view(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "part", "segment", "h"])

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        shard, part, segment = (k.as_py() for k in key)
        block, at = _bits(rows.column("h").to_numpy().view(np.uint64), plan[shard, part][1])
        bits = np.zeros(SEGMENT_BLOCKS * 64, np.uint8)
        for bit in at:
            np.bitwise_or.at(bits, (block - segment * SEGMENT_BLOCKS) * 64 + (bit >> 3), np.left_shift(1, bit & 7).astype(np.uint8))
        return pa.table({"shard": [shard], "part": [part], "segment": [segment], "bits": pa.array([bits.tobytes()], pa.binary())})

    placed = keyed.filter(F.col("shard").isin(list(shards))).select("h", "shard").mapInArrow(place, "shard long, part long, segment long, h long")
    built = placed.groupBy("shard", "part", "segment").applyInArrow(build, "shard long, part long, segment long, bits binary")
    out = {key: np.zeros(-(-blocks // SEGMENT_BLOCKS) * SEGMENT_BLOCKS * 64, np.uint8) for key, (_, blocks) in plan.items()}
    for row in built.toLocalIterator():
        begin = row.segment * SEGMENT_BLOCKS * 64
        out[row.shard, row.part][begin : begin + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return {key: bits[: plan[key][1] * 64] for key, bits in out.items()}


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_count: int, damage: int | None) -> DataFrame:
    """``word, n``: the lower-cased runs of letters of ``min_chars`` code points and more that occur ``min_count`` times."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"({RUN}{{{min_chars},}})"), F.lit(1))).alias("word"),
    )
    if damage:
        h, size = F.crc32(F.concat("doc_id", F.lit(":"), "word")), F.char_length("word")
        at = (h % size).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
        runs = runs.select(F.when(h % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


def near_words(words: DataFrame, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of words of ``words`` (``word, n``) that one inserted, deleted or replaced code point tells apart."""
    spark = words.sparkSession

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("h", pa.array(word_hashes(batch.column("word").to_pylist()).view(np.int64)))

    keyed = words.select("word", "n").mapInArrow(key, "word string, n long, h long")
    keyed = materialize(keyed.withColumn("shard", F.least(F.char_length("word"), F.lit(LONGEST_SHARD)).cast("long")), "spelling-words")
    sizes = {r.shard: r["count"] for r in keyed.groupBy("shard").count().collect()}  # at most LONGEST_SHARD + 1 rows
    # As many letters as the pattern of a run allows.
    letters = keyed.select(F.explode(F.split("word", "")).alias("c")).distinct().select(F.ascii("c")).collect()
    alphabet = np.array(sorted(r[0] for r in letters), np.uint64)
    found = None
    for plan in plan_rounds(sizes, round_blocks):
        sent = spark.sparkContext.broadcast((plan, _filters(keyed, plan)))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            plan, filters = sent.value
            parts = {shard: n for (shard, _), (n, _) in plan.items()}
            for batch in batches:
                own = batch.column(1).to_numpy(zero_copy_only=False)
                for which, codes in _by_length(batch.column(0).to_pylist()):
                    step = max(1, EDITS // (codes.shape[1] * max(1, len(alphabet))))
                    for at in range(0, len(which), step):
                        for size, row, h in edits(codes[at : at + step], alphabet):
                            shard = min(size, LONGEST_SHARD)
                            if shard not in parts:
                                continue
                            part = part_of(h, parts[shard]) if parts[shard] > 1 else np.zeros(len(h), np.int64)
                            for p in range(parts[shard]):
                                if (shard, p) in filters:
                                    mine = np.flatnonzero(part == p)
                                    hit = mine[known(filters[shard, p], h[mine])]
                                    if len(hit):
                                        yield pa.RecordBatch.from_arrays(
                                            [pa.array(own[which[at + row[hit]]]), pa.array(h[hit].view(np.int64))], names=["a", "b"],
                                        )

        positives = materialize(keyed.select("word", "h").mapInArrow(probe, "a long, b long"), "spelling-positives")
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        found = keyed.select(F.col("h").alias("a"), F.col("h").alias("b"))  # no words, no pairs
    # False positives meet no word; words whose hashes agree by accident are told apart by their letters.
    other = keyed.select(F.col("h").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    one = keyed.select(F.col("h").alias("a"), "word", "n")
    pairs = found.join(other, "b").join(one, "a").filter(F.levenshtein("word", "near", 1) == 1)
    pairs = materialize(pairs.select("word", "n", "near", "near_n").dropDuplicates(["word", "near"]), "spelling-pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


def last_of_chain(steps: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last, twice as far every round.

    A form is ``ratio`` times as frequent as its word, so no chain has more steps than a count has digits to that base.
    """
    hops = materialize(steps.select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = hops.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = materialize(stepped, "spelling-hops")
        if stepped.filter("moved").isEmpty():
            return stepped.select("word", "root")
        hops = stepped.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = 6, min_count: int = 5, ratio: int = 5, damage: int | None = None, round_blocks: int = ROUND_BLOCKS,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z lowered, that have ``min_chars`` code
    points and occur ``min_count`` times in all rows (repeated rows count again; null and empty texts have none; an
    empty table gives an empty result; other columns are not read). Words are near if one inserted, deleted or
    replaced code point tells them apart. ``form`` is the near word of largest ``n``, ties to the smallest in code-point order, if
    it is ``ratio`` times as frequent as the word, else null. ``root`` follows forms to the last.

    ``damage``: where that number divides the CRC-32 of ``<doc_id>:<run>`` (a null id is empty), the run loses the code point at
    the CRC modulo its length, which plants misspellings.

    Counts combine before the shuffle. Each word's edits are hashed as arrays and looked up in blocked Bloom filters,
    one per word length; only those they know are shuffled, as two hashes, and joined with the vocabulary. Filters of
    at most ``round_blocks`` 64-byte blocks are broadcast at a time, so a larger vocabulary takes more rounds.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = materialize(vocabulary(docs, id_col, text_col, min_chars, min_count, damage), "spelling-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    around = near_words(words, round_blocks).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    formed = words.join(around, "word", "left").withColumn("best_n", -F.col("best.minus_n"))
    frequent = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = last_of_chain(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
