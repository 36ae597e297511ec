"""Mixing sources to target weights by entropy balancing: Newton on the dual, tilted rates, copies."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import ordered_parts, running_totals, text_key
from cadencia.session import materialize

#: About so many documents of a source are rounded together.
GROUP_ROWS = 2_000
#: A document of more than one in so many words of its group is rounded apart.
HEAVY = 20


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: places where a word begins."""
    bare = F.coalesce(text, F.lit(""))
    return (F.size(F.array_remove(F.split(bare, r"[\x20\x09-\x0D]+"), "")).cast("long"))


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds ``weight``: the given weights in turn, by the sources' code points, null last."""
    order = [F.col("source").asc_nulls_last()]
    parts = materialize(ordered_parts(sources, *order), "mix-sources")
    placed = running_totals(parts, order, nth=F.lit(1)).drop("part")
    return placed.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))).drop("nth")


def water_levels(sources: DataFrame, most: float) -> DataFrame:
    """Adds ``target``: all sizes shared by weight, no source over ``most`` times its size, the excess shared again.

    The shares that are not capped all stand at one level per weight. Every step computes the level from the
    sources that are still below their cap, until no other source reaches it; two numbers come back each time.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap, level, capped = F.lit(float(most)) * F.col("source_size"), 0.0, -1
    while True:
        over = cap <= F.col("weight") * level
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight"), F.count_if(over).alias("n"),
        ).first()
        if row.n == capped or not row.weight:
            break
        capped, level = row.n, (total - row.fixed) / row.weight
    return sources.withColumn("target", F.least(cap, F.col("weight") * level) if row.weight else cap)


def balance(sources: DataFrame, tolerance: float = 1e-12, max_steps: int = 200) -> DataFrame:
    """Adds ``rate``: the tilt of every document of the source.

    Entropy balancing: of all token masses that meet the targets, take the one nearest in relative entropy
    to the corpus, whose documents weigh their sizes. Its dual, ``sum size * exp(lambda_source) - lambda_source * target``, is
    convex, and gradient and Hessian need only each source's total, so one distributed aggregation serves all steps
    and the Hessian is diagonal. A Newton step for all sources is a projection of the written table of multipliers;
    only the largest step is read back. Sources without a target or size have rate 0.
    """
    state = materialize(sources.withColumn("lam", F.lit(0.0)), "mix-multipliers")
    live = (F.col("source_size") > 0) & (F.col("target") > 0)
    for _ in range(max_steps):
        gradient = F.col("source_size") * F.exp("lam") - F.col("target")
        step = F.when(live, gradient / (F.col("source_size") * F.exp("lam"))).otherwise(0.0)
        state = materialize(state.withColumn("step", step).withColumn("lam", F.col("lam") - F.col("step")), "mix-multipliers")
        largest = state.agg(F.max(F.abs("step"))).first()[0] or 0.0
        state = state.drop("step")
        if largest <= tolerance:
            break
    else:
        raise RuntimeError(f"the multipliers did not settle in {max_steps} steps")
    return state.withColumn("rate", F.when(live, F.exp("lam")).otherwise(0.0)).drop("lam")


def _copies(rows: pa.Table) -> pa.Table:
    """Whole copies near the rate: largest documents first, each rounding error is carried to the next one; ``start`` is carried in."""
    order = [("size", "descending"), ("h", "ascending"), *[(c, "ascending") for c in rows.column_names if pa.types.is_primitive(rows.schema.field(c).type) and c not in ("size", "h")]]
    rows = rows.take(pc.sort_indices(rows, sort_keys=order))
    rate, carried = rows["rate"][0].as_py(), rows["start"][0].as_py()
    whole = round(rate) if abs(rate - round(rate)) < 1e-9 else int(rate)
    part = max(0.0, rate - whole)
    copies = []
    for size in rows["size"].to_pylist():
        carried += part * size
        extra = part > 1e-9 and carried >= size / 2
        carried -= size * extra
        copies.append(whole + extra)
    return rows.append_column("copies", pa.array(copies, pa.int64()))


def levels(measured: DataFrame, group_rows: int) -> DataFrame:
    """``source, level, least, groups``: how the documents of each source are dealt for rounding.

    A document longer than a twentieth of the words of its group could leave an error that the rest of the group cannot
    take up. Such documents go to the next level, where they are dealt among themselves in the same way, until one
    group holds all of a level. ``least`` is the length over which a document is in the level. A level has a hundredth of the
    documents of the one before at most (with 2,000 to a group), so there are few.
    """
    found, over = None, None
    for level in range(64):
        rows = measured
        if over is not None:
            rows = measured.join(over, measured["source"].eqNullSafe(F.col("s")) & (measured["size"] > F.col("over"))).drop("s")
        else:
            rows = measured.withColumn("over", F.lit(-1.0))
        dealt = rows.groupBy("source").agg(F.first("over").alias("least"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
        dealt = dealt.withColumn("groups", F.ceil(F.col("n") / group_rows).cast("long")).withColumn("level", F.lit(level))
        dealt = materialize(dealt.withColumn("over", F.greatest(F.col("words") / F.col("groups") / HEAVY, "least")), "mix-level")
        if level and dealt.isEmpty():
            break
        found = dealt if found is None else found.unionByName(dealt)
        over = dealt.filter("groups > 1 and over > least").select(F.col("source").alias("s"), "over")
    return found.select("source", "level", "least", "groups")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3), most: float = 3, group_rows: int = GROUP_ROWS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``doc_id, size, source, source_size, target, copies, taken``.

    ``size`` counts words (null: 0). Sources by code point, null last, weigh ``weights`` in turn and share all sizes, none
    over ``most`` times its own, the excess shared again. Every document of a source gets the same rate, rounded to
    whole copies so that the words taken stay within about one small document per ``group_rows`` of the target: a
    source is dealt by hash into groups of about that many rows, each rounded by itself, so a hot source is many
    tasks. Documents that are long beside their group are rounded before, apart, and the error they leave is shared among the
    groups (``levels``). Runs repeat exactly. Null and empty texts have size 0, take nothing and keep the rate's copies; a
    null source is a source; rows that repeat count each; an empty table gives an empty result. ``carry`` names columns of
    ``docs`` that are added to the result.
    """
    measured = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), words_in(F.col(text_col)).alias("size"), F.col(source_col).alias("source"),
            F.xxhash64(F.col(id_col), text_key(F.col(text_col)), F.lit(3)).alias("h"), *carry,
        ),
        "mix-sizes",
    )
    sources = materialize(measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "mix-totals")
    balanced = materialize(balance(water_levels(materialize(cyclic_weights(sources, weights), "mix-weights"), most)), "mix-rates")
    rated = measured.join(balanced.select(F.col("source").alias("s"), "source_size", "target", "rate"), measured["source"].eqNullSafe(F.col("s"))).drop("s")
    dealt = levels(measured, group_rows)
    top = dealt.agg(F.max("level")).first()[0] or 0
    copied, left = None, None
    for level in range(top, -1, -1):
        # The level's own rows; what the one above left over is shared evenly among its groups.
        here = dealt.filter(F.col("level") == level).select(F.col("source").alias("s"), "least", "groups")
        here = here.join(dealt.filter(F.col("level") == level + 1).select(F.col("source").alias("s1"), F.col("least").alias("most")), F.col("s").eqNullSafe(F.col("s1")), "left").drop("s1")
        if left is None:
            here = here.withColumn("start", F.lit(0.0))
        else:
            here = here.join(left, F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2").withColumn("start", F.coalesce(F.col("left") / F.col("groups"), F.lit(0.0))).drop("left")
        inside = (F.col("size") > F.col("least")) & (F.col("most").isNull() | (F.col("size") <= F.col("most")))
        rows = rated.join(here, rated["source"].eqNullSafe(F.col("s")) & inside).drop("s", "least", "most")
        rows = rows.withColumn("group", F.pmod("h", F.col("groups")))
        rounded = rows.groupBy("source", "group").applyInArrow(_copies, T.StructType([*rows.schema.fields, T.StructField("copies", T.LongType())]))
        if level:
            rounded = materialize(rounded, "mix-rounded")
            # Of every group what it began with and was to take, less what it took.
            of_group = rounded.groupBy("source", "group").agg((F.first("start") + F.sum(F.col("rate") * F.col("size") - F.col("copies") * F.col("size"))).alias("left"))
            left = materialize(of_group.groupBy(F.col("source").alias("s2")).agg(F.sum("left").alias("left")), "mix-left")
        copied = rounded if copied is None else copied.unionByName(rounded)
    return copied.select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *carry,
    )
