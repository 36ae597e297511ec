"""The pipeline, stage by stage, each against a plain version on the rows that the stage before it kept."""

from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from cadencia.llm.quality import score, train
from cadencia.llm.queries import DECONTAMINATION_SQL, SHARDING_SQL

from . import brute

SF = "/root/testdata/sf0.001"


def sql(query, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    con.execute(f"create view benchmark as select * from '{SF}/benchmark.parquet'")
    return con.execute(query).fetchdf()


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each, as pandas."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs.toPandas())
    return out


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding",
    ]
    assert all(list(s.columns) == list(stages[0].columns) for s in stages[:-1])


def test_quality_stage(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = score(docs, train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert sorted(stages[1].doc_id) == sorted(r.doc_id for r in scored if r.predicted)


def test_near_duplicate_stage(stages):
    rows = list(zip(stages[1].doc_id, stages[1].text))
    placed = brute.components(rows)
    assert sorted(stages[2].doc_id) == sorted(d for d, (_, c) in placed.items() if d == c)
    assert len(stages[2]) < len(stages[1])


def test_decontamination_stage(stages):
    found = sql(DECONTAMINATION_SQL, stages[2])
    assert sorted(stages[3].doc_id) == sorted(found.doc_id[~found.contaminated])
    assert found.contaminated.any()


def test_mixing_stage(stages):
    before, after = stages[3], stages[4]
    sizes, taken = defaultdict(int), defaultdict(int)
    for frame, total in ((before, sizes), (after, taken)):
        for source, text in zip(frame.source, frame.text):
            total[source] += len((text or "").encode().split())
    copies = Counter(after.doc_id)
    assert set(copies) <= set(before.doc_id) and max(copies.values()) <= 3
    largest = defaultdict(int)
    for source, text in zip(before.source, before.text):
        largest[source] = max(largest[source], len((text or "").split()))
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= max(20, 0.6 * largest[source])


def test_sharding_stage(stages):
    expected = sql(SHARDING_SQL, stages[4])
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    as_rows = lambda frame: sorted(frame[columns].astype("int64").itertuples(index=False, name=None))
    assert as_rows(stages[5]) == as_rows(expected)


def test_shards_hold_their_documents(stages):
    columns = list(stages[4].columns)
    assert list(stages[5].columns)[: len(columns)] == columns
    as_rows = lambda frame: Counter(frame[columns].itertuples(index=False, name=None))
    assert as_rows(stages[5]) == as_rows(stages[4])


def test_sharding_of_odd_rows(spark):
    rows = [(1, "a", "x", 7, "p"), (1, "a", "x", 7, "p"), (None, None, None, None, None), (2, "", "y", 8, "q"), (3, "wide " * 100_000, None, 9, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, document_size long, size string")
    kept = corpus_pipeline.sharding(spark, docs, SF)
    assert kept.columns[:5] == ["doc_id", "text", "document_shard", "document_size", "document_document_size"]
    assert Counter(tuple(r)[:5] for r in kept.collect()) == Counter(rows)
    assert {r.doc_id: r["size"] for r in kept.collect()} == {1: 2, None: 1, 2: 1, 3: 500_001}


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).toPandas()
    order = ["shard", "slot"]
    pd.testing.assert_frame_equal(rows.sort_values(order).reset_index(drop=True), stages[5].sort_values(order).reset_index(drop=True))


def test_repeated_and_null_ids(spark):
    rows = [(1, "a text", "en", "s", 6), (1, "a text", "en", "s", 6), (None, None, None, None, None), (2, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert len([r for r in kept if r.doc_id == 1]) == 1
    assert len(corpus_pipeline.decontamination(spark, docs, SF).collect()) == 4
    corpus_pipeline.mixing(spark, docs, SF).collect()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert not stage(spark, empty, SF).collect()


def test_rows_under_null_and_shared_ids_are_judged_by_their_own_text(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    clean = [f"row {i} speaks of its own things: " + " ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    rows = [(None, item), (None, clean[0]), (None, clean[1]), (5, item), (5, clean[2]), (3, clean[3]), (5, clean[3]), (5, clean[4]), (2**60 + 1, clean[5])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], schema)
    after = Counter((r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, docs, SF).collect())
    assert after == Counter((d, t) for d, t in rows if t != item)
    # The text of 3 is also one of 5's; the item is under null and 5; all others are alone.
    after = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert after == Counter((d, t) for d, t in rows if (d, t) not in ((5, clean[3]), (5, item)))


def test_copies_are_those_of_the_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None if i % 3 else i + 2**60, f"{i} " + "w " * (i % 7), "en", "ab"[i % 2], i) for i in range(300)]
    rows += [(7, "equal rows", "en", "a", 1)] * 5
    docs = spark.createDataFrame(rows, schema)
    expected = Counter()
    for r in corpus_pipeline.mix(docs.withColumn("t", corpus_pipeline.F.col("text")), carry=("t",)).collect():
        expected[r.doc_id, r.t] += r.copies
    after = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixing(spark, docs, SF).collect())
    assert after == +expected and len({n for (d, _), n in after.items() if d is None}) > 1
