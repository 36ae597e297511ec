"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cadencia.llm.chat import escape, format_conversations, read_loss, read_turns, unescape
from cadencia.llm.decontam import decontaminate
from cadencia.llm.exact import exact_dedup
from cadencia.llm.lines import line_dedup
from cadencia.llm.mixing import mix
from cadencia.llm.pii import find_pii
from cadencia.llm.quality import score, train
from cadencia.llm.repeats import remove_repeats
from cadencia.llm.sharding import shard
from cadencia.llm.simhash import near_dedup

SCHEMA = "doc_id long, text string, source string"
ITEMS = "item_id long, text string"
#: Names that the operators use inside.
CLASHES = ("tk", "h", "g", "key", "keys", "size", "part", "row", "fp", "n", "words", "d", "t", "s", "first", "sha", "shard", "label", "start", "group", "digest", "root", "node")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def benchmark(spark, rows=((1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "just three words"), (2, "just three words"), (3, None), (4, " .. "), (None, "four lonely little words"))):
    return spark.createDataFrame(list(rows), ITEMS)


OPERATORS = {
    "decontaminate": lambda s, d: decontaminate(d, benchmark(s)),
    "score": lambda s, d: score(d, train(d, s.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int"))),
    "mix": lambda s, d: mix(d),
    "remove_repeats": lambda s, d: remove_repeats(d),
    "shard": lambda s, d: shard(d, 4),
    "find_pii": lambda s, d: find_pii(d),
    "line_dedup": lambda s, d: line_dedup(d, min_docs=3),
    "exact_dedup": lambda s, d: exact_dedup(d),
    "near_dedup": lambda s, d: near_dedup(d),
}

LONG = "very long text with x@y.zz in it. " * 20_000
ROWS = [
    (1, "just three words and a bit more", "a"), (1, "just three words and a bit more", "a"), (1, "another text of this id", None), (2, None, "a"), (3, "", None),
    (4, " \t\n ", "b"), (None, "no id", "b"), (None, None, None), (5, LONG, "b"), (6, "ÀÉ just  THREE   words\nÀÉ", "é"),
    (7, "one two three four five six seven eight nine ten eleven twelve thirteen", "a"),
]


def plain(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows_and_clashing_columns(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = OPERATORS[name](spark, docs)
    rows = plain(found)
    assert len(rows) == len(ROWS)
    clashing = docs
    for c in CLASHES:
        clashing = clashing.withColumn(c, F.lit(None).cast("int"))
    assert plain(OPERATORS[name](spark, clashing)) == rows


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    found = OPERATORS[name](spark, spark.createDataFrame([], SCHEMA))
    assert found.columns and not found.collect()


def test_exact_dedup_ties(spark):
    rows = [(5, "a b", None), (3, "a  b", None), (4, "ab ", None), (2, "ab", None), (9, None, None), (8, "", None), (7, " ", None), (6, "z", None), (6, "z", None)]
    found = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found)
    assert got == [
        (2, 3, 4, False), (3, 3, 4, True), (4, 3, 4, False), (5, 3, 4, False), (6, 6, 2, False), (6, 6, 2, True),
        (7, 7, 3, True), (8, 7, 3, False), (9, 7, 3, False),
    ]
    assert {r.text_sha256 for r in found if r.doc_id in (7, 8, 9)} == {EMPTY_SHA}


def test_line_dedup_modes(spark):
    rows = [(i, f"Own {i}\n SHARED\t\nshared\n\n", None) for i in range(4)] + [(9, "shared", None), (10, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    cut = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup(docs, min_docs=5).collect()}
    assert cut[0] == ("Own 0\n\n", 5, 2) and cut[9] == ("", 1, 1) and cut[10] == ("", 1, 0)
    first = {r.doc_id: r.text for r in line_dedup(docs, min_docs=5, keep_first=True).collect()}
    assert first[0] == "Own 0\n SHARED\t\n\n" and first[1] == "Own 1\n\n"
    assert {r.n_dropped for r in line_dedup(docs, min_docs=6).collect()} == {0}
    assert cut == {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup(docs, min_docs=5, max_bits=1 << 16).collect()}


def test_decontamination_of_short_and_long_items(spark):
    found = {(r.doc_id, r.n_words): r for r in decontaminate(spark.createDataFrame(ROWS, SCHEMA), benchmark(spark)).collect()}
    assert (found[1, 7].n_hit, found[1, 7].n_items, found[1, 7].contaminated) == (3, 1, True)
    assert found[1, 7].items_sha256 == hashlib.sha256(b"2").hexdigest()
    assert found[6, 5].n_hit == 3 and found[7, 13].n_hit == 13 and found[2, 0].items_sha256 == EMPTY_SHA
    assert not found[1, 5].contaminated
    none = decontaminate(spark.createDataFrame(ROWS, SCHEMA), benchmark(spark, [(1, None)])).collect()
    assert len(none) == len(ROWS) and not any(r.n_hit or r.contaminated for r in none)


def test_share_of_hits_at_the_limit(spark):
    item = " ".join(f"w{i}" for i in range(13))
    rows = [(1, item + " x" * (13 * 19), None), (2, item + " x" * (13 * 19 + 1), None)]
    found = {r.doc_id: r.contaminated for r in decontaminate(spark.createDataFrame(rows, SCHEMA), benchmark(spark, [(1, item)])).collect()}
    assert found == {1: True, 2: False}


def test_shards_keep_copies_together_and_are_even(spark):
    rows = [(i, f"text number {i} " * (1 + i % 5), None) for i in range(400)] + [(1000 + i, "copy", None) for i in range(60)]
    found = shard(spark.createDataFrame(rows, SCHEMA).repartition(7), 8).collect()
    sizes, slots = {}, {}
    for r in found:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(sizes) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 2 * 60 * 5
    assert len({r.shard for r in found if r.doc_id >= 1000}) == 1
    # A group that no shard can hold is cut.
    huge = shard(spark.createDataFrame([(i, "same", None) for i in range(80)], SCHEMA), 8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in huge) == [10] * 8


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\<\\[\\\\", "[TURN]user[SAYS]x[NEXT]y[/TURN]", "", None, "plain\n\ntext", "<\\<", "[/TURN]"]
    rows = [(1, i, ("user", "assistant", "assistant", "system")[i % 4], t) for i, t in enumerate(texts)] + [(2, 0, None, None), (None, 0, "assistant", "x"), (None, 0, "assistant", "x")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("segments", F.lit(1))
    out = {
        r.conv_id: r for r in format_conversations(docs).select(
            "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss")).collect()
    }
    assert [(t.role, t.text) for t in out[1].turns] == [(r[2], r[3] or "") for r in rows[:8]]
    assert out[1].loss == "".join(r[3] or "" for r in rows[:8] if r[2] == "assistant")
    for control in ("</s>", "[INST]", "[/INST]"):
        assert control not in out[1].formatted.removesuffix("</s>")
    assert [(t.role, t.text) for t in out[2].turns] == [("", "")] and out[None].loss == "xx"
    assert out[1].formatted.count("[TURN]") == 7 - out[1].formatted.count("[NEXT]") + 1
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert not format_conversations(empty).collect()


def test_escape_is_reversible(spark):
    rows = [("".join(c),) for n in range(6) for c in __import__("itertools").product("<\\[", repeat=n)]
    df = spark.createDataFrame(rows, "x string").withColumn("e", escape(F.col("x"))).withColumn("u", unescape(F.col("e")))
    assert df.filter("x <> u").count() == 0 and df.select("e").distinct().count() == len(rows)
