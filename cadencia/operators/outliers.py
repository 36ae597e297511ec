"""Per-route anomaly removal with an isolation forest (Liu, Ting, Zhou 2008).

Every tree is grown on ``tree_rows`` rows of its route, as the algorithm has it; a route's trees draw from a
proportional pool of ``trees * tree_rows`` rows. Scoring covers all rows; the cut is an exact percentile taken from a
bounded histogram. No step holds a whole route.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.session import materialize

FEATURES = ("ECONOMICO", "DIFF_PARTIDA", "INTERVALO_MINUTOS", "DIA_DE_LA_SEMANA", "FRANJA_HORARIA")
CONTAMINATION = 0.01
SEED = 42
TREES = 100
TREE_ROWS = 256
PIECE_ROWS = 100_000  # expected rows of a route scored together
# Forests up to this size in all are sent to every task, which then scores its rows where they are.
SHARED_BYTES = 128 << 20
# Depths are compared as whole numbers of 1/10000 level. The mean depth lies between 0 and 20, so a
# route has at most 200,000 different values and their counts fit in one task.
DEPTH_UNIT = 10_000

_FOREST = T.StructType(
    [
        T.StructField("feature", T.BinaryType()),
        T.StructField("threshold", T.BinaryType()),
        T.StructField("leaf_depth", T.BinaryType()),
    ]
)


def _unsuccessful_search(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    harmonic = np.log(safe - 1) + np.euler_gamma
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * harmonic - 2 * (safe - 1) / safe))


def grow_forest(
    rows: np.ndarray, seed: int, trees: int = TREES, tree_rows: int = TREE_ROWS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grow all trees of a route level by level; node ``k`` has the children ``2k+1`` and ``2k+2``.

    Returns per tree and node the split feature (-1 at a leaf), the threshold and the leaf's depth.
    """
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    depth = int(np.ceil(np.log2(max(size, 2))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int8)
    threshold = np.zeros((trees, nodes))
    leaf_depth = np.zeros((trees, nodes))
    for t in range(trees):
        sample = rows[rng.choice(len(rows), size, replace=False)]
        at = np.zeros(size, dtype=np.int64)
        for level in range(depth + 1):
            present, inverse, counts = np.unique(at, return_inverse=True, return_counts=True)
            open_node = (present >= 2**level - 1) & (counts > 1) & (level < depth)
            order = np.argsort(inverse, kind="stable")
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            low = np.minimum.reduceat(sample[order], starts, axis=0)
            high = np.maximum.reduceat(sample[order], starts, axis=0)
            varying = high > low
            open_node &= varying.any(axis=1)
            # A random one of the features that still vary in the node.
            draw = np.where(varying, rng.random(varying.shape), -1.0)
            chosen = draw.argmax(axis=1)
            pick = np.arange(len(present)), chosen
            cut = low[pick] + rng.random(len(present)) * (high[pick] - low[pick])
            settled = (present >= 2**level - 1) & ~open_node
            leaf_depth[t, present[settled]] = level + _unsuccessful_search(counts[settled])
            feature[t, present[open_node]] = chosen[open_node]
            threshold[t, present[open_node]] = cut[open_node]
            moving = open_node[inverse]
            right = sample[np.arange(size), chosen[inverse]] > cut[inverse]
            at = np.where(moving, 2 * at + 1 + right, at)
    return feature, threshold, leaf_depth


def mean_depth(
    rows: np.ndarray, feature: np.ndarray, threshold: np.ndarray, leaf_depth: np.ndarray
) -> np.ndarray:
    """Mean leaf depth of each row over the trees, in units of 1/10000; shallow means anomalous."""
    total = np.zeros(len(rows))
    index = np.arange(len(rows))
    levels = int(np.log2(feature.shape[1] + 1)) - 1
    for t in range(len(feature)):
        at = np.zeros(len(rows), dtype=np.int64)
        for _ in range(levels):
            f = feature[t, at]
            right = rows[index, np.maximum(f, 0)] > threshold[t, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        total += leaf_depth[t, at]
    return np.rint(total / len(feature) * DEPTH_UNIT).astype(np.int64)


def _train(features: Sequence[str], group: str, trees: int, tree_rows: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        # Sorted vectors and a fixed seed: the same route gives the same forest on any cluster.
        pdf = pdf.sort_values(list(features))
        vectors = pdf[list(features)].to_numpy(float)
        feature, threshold, leaf = grow_forest(np.repeat(vectors, pdf["copies"], axis=0), SEED, trees, tree_rows)
        return pd.DataFrame(
            {
                group: [pdf[group].iloc[0]],
                "nodes": [feature.shape[1]],
                "pieces": [int(pdf["pieces"].iloc[0])],
                "feature": [feature.tobytes()],
                "threshold": [threshold.tobytes()],
                "leaf_depth": [leaf.tobytes()],
            }
        )

    return fit


def _arrays(model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shape = (-1, int(model["nodes"]))
    return (
        np.frombuffer(model["feature"], np.int8).reshape(shape), np.frombuffer(model["threshold"], float).reshape(shape),
        np.frombuffer(model["leaf_depth"], float).reshape(shape),
    )


def _score(features: Sequence[str], columns: Sequence[str]):
    def score(rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        out = rows[list(columns)].copy()
        if rows.empty:
            return out.assign(depth=pd.Series(dtype="int64"))
        out["depth"] = mean_depth(rows[list(features)].to_numpy(float), *_arrays(forest.iloc[0]))
        return out

    return score


def _join_group(rows: DataFrame, per_group: DataFrame, group: str) -> DataFrame:
    """Rows with what is known of their group; rows without a group are a group too."""
    named = per_group.withColumnRenamed(group, "_group")
    return rows.join(named, rows[group].eqNullSafe(named["_group"])).drop("_group")


def _score_in_place(features: Sequence[str], group: str, shared):
    def score(batches):
        for rows in batches:
            depth = np.zeros(len(rows), np.int64)
            for name, at in rows.groupby(group, dropna=False).indices.items():
                depth[at] = mean_depth(rows.iloc[at][list(features)].to_numpy(float), *_arrays(shared.value[None if pd.isna(name) else name]))
            yield rows.assign(depth=depth)

    return score


def training_pool(
    df: DataFrame, sizes: DataFrame, group: str, features: Sequence[str], pool_rows: int = TREES * TREE_ROWS,
) -> DataFrame:
    """About ``pool_rows`` rows per group, as distinct feature vectors with ``copies``.

    Equal vectors are counted before the shuffle, so a crowd of copies is one row here. A vector
    with ``n`` of the group's ``N`` rows gets ``n * pool_rows / N`` copies, rounded up or down by its
    hash: proportional, and the same on any partitioning. Small groups are kept whole.
    """
    vectors = [F.col(f).cast("double").alias(f) for f in features]
    counted = df.select(group, *vectors).groupBy(group, *features).agg(F.count("*").alias("n"))
    position = F.xxhash64(F.lit(SEED), *features).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    share = F.least(F.lit(1.0), F.lit(float(pool_rows)) / F.col("group_rows"))
    copies = F.floor(F.col("n") * share + F.least(position, F.lit(0.999999))).cast("bigint")
    return (
        _join_group(counted, sizes, group)
        .select(group, "pieces", *features, copies.alias("copies"))
        .filter("copies > 0")
    )


def depth_scores(
    df: DataFrame, group: str = "RUTA", features: Sequence[str] = FEATURES,
    trees: int = TREES, tree_rows: int = TREE_ROWS, shared_bytes: int = SHARED_BYTES,
) -> DataFrame:
    """All rows with ``depth``, the mean isolation depth under the forest of their group.

    ``df`` must be a stored table: it is read several times. Group sizes and forests are written, and so measured: forests
    of up to ``shared_bytes`` in all go to every task, and rows are scored where they are scanned. More forests
    than that meet the rows of their group in pieces of about ``PIECE_ROWS``; the scores are the same.
    """
    columns = df.columns
    sizes = materialize(
        df.groupBy(group).agg(F.count("*").alias("group_rows"))
        .withColumn("pieces", F.ceil(F.col("group_rows") / PIECE_ROWS).cast("bigint")),
        "outliers-sizes",
    )
    model_schema = T.StructType(
        [df.schema[group], T.StructField("nodes", T.IntegerType()), T.StructField("pieces", T.LongType())]
        + _FOREST.fields
    )
    forests = materialize(
        training_pool(df, sizes, group, features, trees * tree_rows)
        .groupBy(group)
        .applyInPandas(_train(features, group, trees, tree_rows), model_schema),
        "outliers-forests",
    )
    scored = T.StructType([*df.schema.fields, T.StructField("depth", T.LongType())])
    used = forests.agg(F.sum(F.octet_length("feature") + F.octet_length("threshold") + F.octet_length("leaf_depth"))).first()[0] or 0
    if used <= shared_bytes:
        shared = df.sparkSession.sparkContext.broadcast({r[group]: r.asDict() for r in forests.collect()})
        return df.mapInPandas(_score_in_place(features, group, shared), scored)
    per_piece = forests.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))
    ).drop("pieces")
    # The row number only spreads the rows over pieces.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    pieces = _join_group(numbered, sizes.select(group, "pieces"), group).withColumn(
        "piece", F.pmod(F.xxhash64("_row"), F.col("pieces"))
    )
    return (
        pieces.drop("_row", "pieces").groupBy(group, "piece")
        .cogroup(per_piece.groupBy(group, "piece"))
        .applyInPandas(_score(features, columns), scored)
    )


def depth_cuts(scored: DataFrame, group: str = "RUTA", contamination: float = CONTAMINATION) -> DataFrame:
    """Exact interpolated percentile of the depth per group, from counts per depth."""
    histogram = scored.groupBy(group, "depth").agg(F.count("*").alias("n"))
    return histogram.groupBy(group).agg(
        F.percentile("depth", F.lit(contamination), F.col("n")).alias("cut")
    )


def without_outliers(
    df: DataFrame, group: str = "RUTA", contamination: float = CONTAMINATION,
    features: Sequence[str] = FEATURES, trees: int = TREES, tree_rows: int = TREE_ROWS, stored: bool = False,
) -> DataFrame:
    """Rows that are not among the ``contamination`` share of most isolated rows of their group.

    Runs jobs: the scores, and the input unless it is a ``stored`` table, are written to the shared folder once.
    """
    base = df if stored else materialize(df, "outliers-in")
    scored = materialize(depth_scores(base, group, features, trees, tree_rows), "outliers-scored")
    cuts = materialize(depth_cuts(scored, group, contamination), "outliers-cuts")
    return _join_group(scored, cuts, group).filter("depth >= cut").select(*df.columns)


def warn_if_over_cut(before: int, after: int, contamination: float = CONTAMINATION) -> None:
    """Losing more than half the rows is not what the model is for."""
    if before and after / before < 0.5:
        warnings.warn(
            f"the outlier model removed {before - after} of {before} rows; "
            f"about {contamination:.0%} was expected",
            RuntimeWarning,
            stacklevel=2,
        )
