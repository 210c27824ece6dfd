"""Additive explanations: per-row feature contributions and the reports built on them.

Contributions are kept long, ``(row_id, feature, value)``; every report is an aggregate or a
per-row top-k over that table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tenura.functions.expressions import driver_direction
from tenura.operators.segments import lookup
from tenura.session import shared_folder

# Report sizes.
TOP_CUSTOMERS, TOP_DRIVERS, TOP_FEATURES, INSIGHTS = 100, 3, 15, 4

#: Features of a tree's path up to which all patterns of its decisions are worked out, and paths at a time.
PATTERN_FEATURES, PATTERN_PATHS = 8, 256

# Feature -> business label.
FEATURE_LABELS = {
    "eqpdays": "Equipment Age",
    "old_phone": "Outdated Device",
    "months": "Customer Tenure",
    "mou_Mean": "Average Call Volume",
    "drop_rate": "Call Drop Rate",
    "recent_usage_delta": "Declining Usage Trend",
    "rev_Mean": "Revenue Volatility",
    "change_mou": "Usage Change Rate",
    "totrev": "Total Billed Revenue",
    "avgmou": "Average Usage",
}


def linear_attribution(
    df: DataFrame, coefficients: Mapping[str, float], *, row_id: str = "row_id"
) -> DataFrame:
    """``row_id, feature, value`` with value = coefficient * (x - mean of x), NULL inputs as the mean.

    The means are one aggregate row (scalar subquery); the rest is a projection.
    """
    features = list(coefficients)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in features]).alias("m")).scalar()
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            (F.lit(float(w)) * F.coalesce(F.col(c) - F.col("m")[c], F.lit(0.0))).alias("value"),
        )
        for c, w in coefficients.items()
    ]
    return df.select(row_id, *features, means.alias("m")).select(row_id, F.inline(F.array(*parts)))


def linear_scores(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float = 0.0, *, row_id: str = "row_id"
) -> DataFrame:
    """``row_id, prob`` of the centred linear model; a projection, so no row moves."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients]).alias("m")).scalar()
    terms = [
        F.lit(float(w)) * F.coalesce(F.col(c) - F.col("m")[c], F.lit(0.0)) for c, w in coefficients.items()
    ]
    margin = sum(terms, F.lit(float(intercept)))
    return df.select(row_id, *coefficients, means.alias("m")).select(
        row_id, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("prob")
    )


def global_importance(contributions: DataFrame, k: int | None = TOP_FEATURES) -> DataFrame:
    """Mean absolute contribution, mean contribution and direction per feature."""
    grouped = contributions.groupBy("feature").agg(
        F.avg(F.abs("value")).alias("importance"), F.avg("value").alias("mean_value")
    )
    grouped = grouped.withColumn("direction", driver_direction(F.col("mean_value")))
    return grouped if k is None else grouped.orderBy(F.desc("importance"), "feature").limit(k)


def waterfall(contributions: DataFrame, row: int, base: float | Column, *, row_id: str = "row_id") -> DataFrame:
    """One row's contributions, largest first, with running start and end from the base value.

    The window orders the features of a single row.
    """
    largest = Window.partitionBy(row_id).orderBy(F.desc(F.abs("value")), "feature")
    one = contributions.where(F.col(row_id) == row)
    start = base if isinstance(base, Column) else F.lit(float(base))
    end = start + F.sum("value").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    return one.select(
        row_id, F.row_number().over(largest).alias("step"), "feature", "value", end.alias("end")
    ).withColumn("start", F.col("end") - F.col("value"))


def top_drivers(
    contributions: DataFrame,
    scores: DataFrame,
    *,
    customers: int = TOP_CUSTOMERS,
    features: int = TOP_DRIVERS,
    row_id: str = "row_id",
    prob: str = "prob",
) -> DataFrame:
    """``rank, churn_probability, top_drivers`` of the riskiest rows, values rounded to 4 digits.

    The riskiest rows are picked first (a bounded top-k), so only their contributions are joined
    and ordered.
    """
    risky = scores.select(row_id, prob).orderBy(F.desc(prob), row_id).limit(customers)
    by_risk = Window.orderBy(F.desc(prob), row_id)  # over the limited rows only
    ranked = risky.withColumn("rank", F.row_number().over(by_risk))
    # At most ``customers`` rows.
    mine = contributions.join(F.broadcast(ranked), row_id)
    by_size = Window.partitionBy(row_id).orderBy(F.desc(F.abs("value")), "feature")
    kept = mine.withColumn("place", F.row_number().over(by_size)).where(F.col("place") <= features)
    item = F.struct(
        "place", "feature", F.bround("value", 4).alias("shap_value"), driver_direction(F.col("value")).alias("direction")
    )
    grouped = kept.groupBy("rank", row_id, prob).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return grouped.select(
        "rank", row_id, F.bround(prob, 4).alias("churn_probability"),
        F.transform(
            "items", lambda i: F.struct(i["feature"].alias("feature"), i["shap_value"].alias("shap_value"),
                                        i["direction"].alias("direction"))
        ).alias("top_drivers"),
    )


def driver_rollup(drivers: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS) -> DataFrame:
    """Summed absolute driver value per feature with its business label, highest first."""
    name = F.coalesce(lookup(F.col("feature"), dict(labels)), F.initcap(F.replace(F.col("feature"), F.lit("_"), F.lit(" "))))
    return (
        drivers.select(F.inline("top_drivers"))
        .groupBy("feature")
        .agg(F.sum(F.abs("shap_value")).alias("total"))
        .withColumn("label", name)
        .orderBy(F.desc("total"), "feature")
    )


def insight_features(rollup: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS, k: int = INSIGHTS) -> DataFrame:
    """The first few roll-up rows that have a business text."""
    return rollup.where(F.col("feature").isin(*labels)).orderBy(F.desc("total"), "feature").limit(k)


# ---- tree ensembles ----------------------------------------------------------------------------


def ensemble_nodes(spark: SparkSession, model) -> list[dict]:
    """The fitted ensemble as plain arrays per tree: feature, threshold, categories, children, value, cover.

    Read from the node table of the saved model. Values are log-odds: Spark's probability is
    1 / (1 + exp(-2 * margin)), so a leaf counts twice. The first impurity statistic of a node is its
    training weight; children are numbered in pre-order. The result is model-sized metadata.
    """
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    weights = list(model.treeWeights)
    table = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id")
    trees: dict[int, dict[str, list]] = {}
    for r in table.collect():
        tree = trees.setdefault(r["treeID"], {n: [] for n in ("feature", "threshold", "rule", "left", "right", "value", "cover")})
        leaf, split = r["leftChild"] < 0, r["split"]
        categorical = not leaf and split["numCategories"] >= 0
        tree["feature"].append(-1 if leaf else split["featureIndex"])
        tree["threshold"].append(0.0 if leaf or categorical else split["leftCategoriesOrThreshold"][0])
        tree["rule"].append(frozenset(split["leftCategoriesOrThreshold"]) if categorical else None)
        tree["left"].append(r["leftChild"])
        tree["right"].append(r["rightChild"])
        tree["value"].append(2.0 * r["prediction"] * weights[r["treeID"]] if leaf else 0.0)
        tree["cover"].append(float(r["impurityStats"][0]))
    return [trees[i] for i in sorted(trees)]


def leaf_paths(tree: dict) -> list[tuple[float, list[tuple[int, list[tuple[int, bool]], float]]]]:
    """Per leaf: its value and, per feature on the path, the decisions and the cover ratio product."""
    paths = []

    def walk(node: int, seen: dict[int, tuple[list[tuple[int, bool]], float]]) -> None:
        f = tree["feature"][node]
        if f < 0:
            paths.append((tree["value"][node], [(k, d, z) for k, (d, z) in seen.items()]))
            return
        for child, goes_left in ((tree["left"][node], True), (tree["right"][node], False)):
            decisions, ratio = seen.get(f, ([], 1.0))
            share = tree["cover"][child] / tree["cover"][node] if tree["cover"][node] else 0.0
            walk(child, seen | {f: (decisions + [(node, goes_left)], ratio * share)})

    walk(0, {})
    return paths


def _subset_weights(m: int) -> np.ndarray:
    """Shapley weight of a subset of size s among the other m-1 players."""
    out = np.empty(m)
    for s in range(m):
        w = 1.0 / m
        for i in range(1, s + 1):
            w *= i / (m - i)
        out[s] = w
    return out


def _path_values(ones: np.ndarray, zeros: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shapley factor of each feature of a path, for paths by patterns by features.

    ``ones`` (patterns by features) says whether a feature's decisions hold, ``zeros`` (paths by features) is the training
    share that follows them. The product of (zero + one * t) over all features is built once; each feature is taken out of
    it again by one division.
    """
    (patterns, m), paths = ones.shape, len(zeros)
    shares = zeros[:, None, :]
    whole = np.zeros((paths, patterns, m + 1))
    whole[..., 0] = 1.0
    for j in range(m):
        whole[..., 1 : j + 2] = whole[..., 1 : j + 2] * shares[..., j : j + 1] + whole[..., : j + 1] * ones[:, j : j + 1]
        whole[..., 0] *= shares[..., j]
    out = np.empty((paths, patterns, m))
    for k in range(m):
        share = shares[..., k : k + 1]
        # with the feature's decisions met: divide by (zero + t) from the top; else by the constant zero
        rest = np.zeros((paths, patterns, m))
        rest[..., m - 1] = whole[..., m]
        for s in range(m - 1, 0, -1):
            rest[..., s - 1] = whole[..., s] - shares[..., k] * rest[..., s]
        by_zero = np.divide(whole[..., :m], share, out=rest.copy(), where=share > 0)
        rest = np.where(ones[:, k : k + 1] > 0, rest, by_zero)
        out[..., k] = (ones[:, k] - shares[..., k]) * (rest @ weights)
    return out


def _pattern_values(paths: list) -> Iterator[np.ndarray | None]:
    """Per path the Shapley factors of all patterns of its decisions, features by patterns; none where they are too many."""
    for start in range(0, len(paths), PATTERN_PATHS):
        shares = [[z for _, _, z in parts] for _, parts in paths[start : start + PATTERN_PATHS]]
        found: list[np.ndarray | None] = [None] * len(shares)
        for m in {len(z) for z in shares if 0 < len(z) <= PATTERN_FEATURES}:
            mine = [i for i, z in enumerate(shares) if len(z) == m]
            ones = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
            for i, values in zip(mine, _path_values(ones, np.array([shares[i] for i in mine]), _subset_weights(m))):
                found[i] = np.ascontiguousarray(values.T)
        yield from found


def attribute_batch(x: np.ndarray, trees: list[dict], n_features: int) -> tuple[np.ndarray, float]:
    """Exact path-dependent Shapley values of a batch, and the expected log-odds.

    For one leaf a feature is in the path with ``one`` = 1 when the row satisfies all its decisions
    and with ``zero`` = the training share that does. A leaf's worth for a coalition is the product
    of the members' ``one`` and the others' ``zero``, so its Shapley values follow from the
    elementary symmetric polynomials of the path. They only depend on which decisions a row meets,
    so all patterns of a tree's leaves are worked out together and each row looks up its own; a path
    of more than eight features has too many, and there only the patterns that rows meet are.
    """
    columns = np.ascontiguousarray(x.T)
    phi = np.zeros((n_features, len(x)))
    base = 0.0
    for tree in trees:
        if "paths" not in tree:
            tree["paths"] = leaf_paths(tree)
        side_of = {}
        for node, f in enumerate(tree["feature"]):
            if f >= 0:
                rule = tree["rule"][node]
                left = np.isin(columns[f], list(rule)) if rule is not None else columns[f] <= tree["threshold"][node]
                side_of[node, True], side_of[node, False] = left, ~left
        for (value, parts), known in zip(tree["paths"], _pattern_values(tree["paths"])):
            zeros = np.array([z for _, _, z in parts])
            base += value * float(np.prod(zeros)) if parts else value
            if not parts:
                continue
            met = np.zeros(len(x), np.int64)
            for k, (_, decisions, _) in enumerate(parts):
                held = side_of[decisions[0]]
                for decision in decisions[1:]:
                    held = held & side_of[decision]
                met |= held.astype(np.int64) << k
            if known is None:
                patterns, met = np.unique(met, return_inverse=True)
                ones = (patterns[:, None] >> np.arange(len(parts)) & 1).astype(float)
                known = _path_values(ones, zeros[None], _subset_weights(len(parts)))[0].T
            for (f, _, _), factors in zip(parts, value * known):
                phi[f] += factors.take(met)
    return phi.T, base


def tree_attribution(
    df: DataFrame, trees: list[dict], features: list[str], *, vector: str = "features", row_id: str = "row_id"
) -> DataFrame:
    """``row_id, feature, value`` in log-odds for every row; the model ships with the tasks.

    Rows stay where they are: one Arrow batch in, one batch of contributions out.
    """
    from pyspark.ml.functions import vector_to_array

    model = df.sparkSession.sparkContext.broadcast(trees)  # model-sized

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            phi, _ = attribute_batch(np.stack(batch["x"].to_numpy()), model.value, len(features))
            yield pd.DataFrame(
                {
                    "row_id": np.repeat(batch["row_id"].to_numpy(), len(features)),
                    "feature": np.tile(np.asarray(features, dtype=object), len(batch)),
                    "value": phi.ravel(),
                }
            )

    narrow = df.select(F.col(row_id).cast("bigint").alias("row_id"), vector_to_array(vector).alias("x"))
    return narrow.mapInPandas(explain, "row_id bigint, feature string, value double")


def expected_margin(trees: list[dict]) -> float:
    return sum(
        value * float(np.prod([z for _, _, z in parts])) for tree in trees for value, parts in leaf_paths(tree)
    )
