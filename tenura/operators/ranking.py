"""Global order without a global sort task.

``Window.orderBy`` without ``partitionBy`` sends every row to one task. The helpers here cut the
order into buckets at approximate quantiles (``approxQuantile`` + ``Bucketizer``), sum up each
bucket, and run the window inside the buckets; the running total of the few bucket sums is added
as an offset. Split points are literals in the plan, so a recomputed task assigns the same buckets.

A value that is itself a split point gets a bucket of its own, so one value holding a third of all
rows never shares its bucket; where rows (not distinct values) are ranked, such a hot bucket is
split further by ``row_id``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

MAX_BUCKETS = 4096
MAX_ROW_ID_SPLITS = 256
BROADCAST_ROWS = 100_000


def default_buckets(spark: SparkSession) -> int:
    """Four buckets per shuffle partition, so tasks stay even when buckets are not."""
    return min(MAX_BUCKETS, max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


@dataclass(frozen=True)
class SplitPoints:
    """Sorted distinct quantiles of one column; ``hot`` marks those drawn more than once."""

    edges: tuple[float, ...]
    hot: tuple[bool, ...]

    @classmethod
    def of(cls, quantiles: list[float]) -> "SplitPoints":
        edges = sorted({q for q in quantiles if math.isfinite(q)})
        return cls(tuple(edges), tuple(quantiles.count(e) > 1 for e in edges))

    @property
    def codes(self) -> int:
        return 2 * len(self.edges) + 1


def split_points(df: DataFrame, columns: list[str], buckets: int | None = None) -> dict[str, SplitPoints]:
    """Approximate quantiles of several columns in one pass over the table."""
    k = buckets or default_buckets(df.sparkSession)
    quantiles = df.approxQuantile(columns, [i / k for i in range(1, k)], 1 / (4 * k))
    return {c: SplitPoints.of(q) for c, q in zip(columns, quantiles)}


def with_interval(df: DataFrame, column: str, points: SplitPoints, output: str) -> DataFrame:
    """Number of split points at or below the value (binary search inside the JVM)."""
    if not points.edges:
        return df.withColumn(output, F.lit(0))
    splits = [float("-inf"), *points.edges, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol=column, outputCol=output, handleInvalid="keep")
    return bucketizer.transform(df).withColumn(output, F.col(output).cast("int"))


def double_array(values: tuple[float, ...]) -> Column:
    """A literal array in one expression; element-wise literals are slow for thousands of values."""
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


def order_code(value: Column, interval: Column, points: SplitPoints) -> Column:
    """Even codes are open intervals between split points, odd codes the split points themselves."""
    if not points.edges:
        return F.lit(0)
    at_edge = F.get(double_array(points.edges), interval - 1) == value
    # Never NULL: otherwise the joins on it add a filter to one branch only, and the two branches
    # of a prefix sum no longer share their shuffle.
    return F.coalesce(interval * 2 - F.coalesce(at_edge, F.lit(False)).cast("int"), F.lit(-1))


def with_order_codes(df: DataFrame, columns: list[str], points: dict[str, SplitPoints]) -> DataFrame:
    """Add ``__code_<column>`` for each column, all in one projection."""
    cut = [c for c in columns if points[c].edges]
    before = df.columns
    if cut:
        splits = [[float("-inf"), *points[c].edges, float("inf")] for c in cut]
        df = Bucketizer(
            splitsArray=splits, inputCols=cut, outputCols=[f"__at_{c}" for c in cut], handleInvalid="keep"
        ).transform(df)

    def code(c: str) -> Column:
        at = F.col(f"__at_{c}").cast("int") if c in cut else F.lit(0)
        return order_code(F.col(c).cast("double"), at, points[c]).alias(f"__code_{c}")

    return df.select(*before, *[code(c) for c in columns])


def tall_with_buckets(
    df: DataFrame, columns: list[str], keep: list[str], buckets: int | None = None
) -> tuple[DataFrame, int]:
    """Unpivot columns to ``(series, value, bucket, keep...)``; NULL and NaN values drop out.

    Also returns an upper bound for the number of (series, bucket) pairs.
    """
    points = split_points(df, columns, buckets)
    coded = with_order_codes(df.select(*columns, *keep), columns, points)
    entries = [
        F.struct(
            F.lit(c).alias("series"),
            F.col(c).cast("double").alias("value"),
            F.col(f"__code_{c}").alias("bucket"),
        )
        for c in columns
    ]
    tall = coded.select(*keep, F.inline(F.array(*entries)))
    tall = tall.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return tall, sum(points[c].codes for c in columns)


def add_prefix_sums(
    cells: DataFrame,
    group: list[str],
    order: list[Column],
    measures: list[str],
    *,
    descending_buckets: bool = False,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Add ``<measure>_before``, the sum over all rows earlier in the group's order, and
    ``<measure>_total``, the sum over the whole group.

    ``cells`` carries ``bucket``; ``order`` must agree with the bucket order. Both come from the
    bucket sums, so no further pass over the rows is needed for group totals.
    """
    bucket_order = F.desc("bucket") if descending_buckets else F.asc("bucket")
    totals = cells.groupBy(*group, "bucket").agg(*[F.sum(m).alias(m) for m in measures])
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "bucket",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"__off_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    if bucket_rows is not None and bucket_rows <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    inside = (
        Window.partitionBy(*group, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = cells.join(offsets, [*group, "bucket"])
    before = [
        (F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"__off_{m}")).alias(f"{m}_before") for m in measures
    ]
    return joined.select(*cells.columns, *before, *[f"{m}_total" for m in measures])


def value_cells(
    df: DataFrame,
    columns: list[str],
    label: str | None = None,
    *,
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (series, distinct value) with counts and the counts that come before it.

    Columns: ``series, value, n, pos, n_before, pos_before, n_total, pos_total`` (``pos`` counts
    label 1). Equal
    values are merged before any ordering, so ties and hot values cost one row.
    """
    work = df.select(*columns, (F.col(label).cast("bigint") if label else F.lit(0).cast("bigint")).alias("__y"))
    tall, bound = tall_with_buckets(work, columns, ["__y"], buckets)
    cells = tall.groupBy("series", "bucket", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__y").alias("pos")
    )
    order = F.desc("value") if descending else F.asc("value")
    return add_prefix_sums(
        cells, ["series"], [order], ["n", "pos"], descending_buckets=descending, bucket_rows=bound
    ).drop("bucket")


def cells_at_ranks(df: DataFrame, columns: list[str], wanted: Callable[[Column], Column]) -> DataFrame:
    """``series, value, n, n_before, n_total`` as ``value_cells`` has them, of the buckets that hold a wanted rank only.

    ``wanted`` makes an array of 0-based ranks from a column's number of values. Buckets are counted map-side first, so
    values of other buckets are neither shuffled nor ordered.
    """
    tall, _ = tall_with_buckets(df, columns, [])
    counts = tall.groupBy("series", "bucket").agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("series")
    placed = counts.select(
        "series", "bucket", "__rows", F.sum("__rows").over(whole.orderBy("bucket")).alias("__upto"),
        F.sum("__rows").over(whole).alias("n_total"),
    )
    before = F.col("__upto") - F.col("__rows")
    held = placed.where(F.exists(wanted(F.col("n_total")), lambda r: (r >= before) & (r < F.col("__upto"))))
    # at most a row for each column and wanted rank
    held = F.broadcast(held.select("series", "bucket", before.alias("__off"), "n_total"))
    cells = tall.join(held, ["series", "bucket"]).groupBy("series", "bucket", "value", "__off", "n_total").agg(
        F.count(F.lit(1)).alias("n")
    )
    inside = Window.partitionBy("series", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        "series", "value", "n", (F.coalesce(F.sum("n").over(inside), F.lit(0)) + F.col("__off")).alias("n_before"), "n_total"
    )


def rank_rows(
    df: DataFrame,
    score: str,
    row_id: str,
    measures: list[str] | None = None,
    *,
    descending: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Add the exact 1-based ``rank`` by score, ties by ``row_id``, running ``<measure>_upto``, and
    the totals ``n_rows`` and ``<measure>_total``.

    Rows with a NULL score are left out, as they have no place in the order.
    """
    measures = measures or []
    scored = df.where(F.col(score).isNotNull())
    found = split_points(scored, list(dict.fromkeys([score, row_id])), buckets)
    points = found[score]
    coded = with_interval(scored, score, points, "__at")
    code = order_code(F.col(score).cast("double"), F.col("__at"), points)
    sub = F.lit(0)
    width = 1
    if any(points.hot) and row_id != score:
        ids = found[row_id].edges
        step = -(-len(ids) // MAX_ROW_ID_SPLITS) or 1
        ids = SplitPoints(ids[::step], ())
        width = len(ids.edges) + 1
        coded = with_interval(coded, row_id, ids, "__rid")
        is_hot = (code % 2 == 1) & F.get(F.expr(f"array({', '.join(str(h).lower() for h in points.hot)})"), F.col("__at") - 1)
        sub = F.when(is_hot, F.col("__rid")).otherwise(0)
    place = (F.lit(points.codes - 1) - code) if descending else code
    coded = coded.select(
        *df.columns, F.coalesce((place * width + sub).cast("bigint"), F.lit(-1)).alias("bucket"), F.lit(1).cast("bigint").alias("__one")
    )
    bound = points.codes + sum(points.hot) * width
    order = [F.desc(score) if descending else F.asc(score), F.asc(row_id)]
    ranked = add_prefix_sums(coded, [], order, ["__one", *measures], bucket_rows=bound)
    return ranked.select(
        *df.columns,
        (F.col("__one_before") + 1).alias("rank"),
        *[(F.col(f"{m}_before") + F.col(m)).alias(f"{m}_upto") for m in measures],
        F.col("__one_total").alias("n_rows"),
        *[f"{m}_total" for m in measures],
    )


def rank_in_class_by_hash(
    df: DataFrame, hash_column: str, row_id: str, group: str, *, buckets: int | None = None
) -> DataFrame:
    """Exact 1-based ``rank`` per class by a uniform 32-bit hash, ties by ``row_id``.

    The hash is uniform, so an even grid over its range already balances the buckets.
    Also adds ``class_rows``, the size of the class.
    """
    k = buckets or default_buckets(df.sparkSession)
    coded = df.withColumn(
        "bucket", F.coalesce(F.floor(F.col(hash_column) * F.lit(k) / F.lit(2.0**32)).cast("int"), F.lit(-1))
    )
    totals = coded.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group, "bucket",
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__off"),
        F.sum("__rows").over(whole).alias("class_rows"),
    )
    inside = Window.partitionBy(group, "bucket").orderBy(hash_column, row_id)
    return (
        coded.join(offsets, [group, "bucket"])
        .withColumn("rank", F.col("__off") + F.row_number().over(inside))
        .drop("__off", "bucket")
    )


def smallest_in_class(rows: DataFrame, quota: Callable[[Column], Column]) -> DataFrame:
    """``class, u, id``: the row that ends the first ``quota(class rows)`` of each class in the order of (u, id).

    ``u`` is a uniform 32-bit hash. Its leading twelve bits are counted, then the next twelve of the one bucket of each
    class in which the wanted row lies; only the rows that agree with it in 24 bits are ordered. A class whose quota is
    zero has no row.
    """
    known = rows.where(F.col("class").isNotNull())
    whole = Window.partitionBy("class")
    wanted = None
    for keep in (20, 8):
        head = F.shiftright("u", keep)
        inside = known if wanted is None else known.join(F.broadcast(wanted), ["class"]).where(F.shiftright("u", 20) == F.col("head"))
        counts = inside.groupBy("class", head.alias("head"), *([] if wanted is None else ["rest"])).agg(F.count(F.lit(1)).alias("rows"))
        rest = quota(F.sum("rows").over(whole)) if wanted is None else F.col("rest")
        placed = counts.select("class", "head", "rows", rest.alias("rest"), F.sum("rows").over(whole.orderBy("head")).alias("upto"))
        found = placed.where((F.col("rest") <= F.col("upto")) & (F.col("rest") > F.col("upto") - F.col("rows")))
        # one row for each class
        wanted = found.select("class", "head", (F.col("rest") - F.col("upto") + F.col("rows")).alias("rest"))
    last = known.join(F.broadcast(wanted), ["class"]).where(F.shiftright("u", 8) == F.col("head"))
    ordered = last.withColumn("place", F.row_number().over(whole.orderBy("u", "id")))
    return ordered.where(F.col("place") == F.col("rest")).select("class", "u", "id")


def ranks_at(probabilities: list[float], rows: Column) -> Column:
    """Array of (q, lower 0-based rank, fraction) for numpy-style linear quantiles of ``rows`` values."""
    return F.array(
        *[
            F.struct(
                F.lit(q).alias("q"),
                F.floor(F.lit(q) * (rows - 1)).cast("bigint").alias("lower"),
                (F.lit(q) * (rows - 1) - F.floor(F.lit(q) * (rows - 1))).alias("fraction"),
            )
            for q in probabilities
        ]
    )


def quantiles_from_cells(cells: DataFrame, group: list[str], probabilities: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles per group from cumulated value cells.

    ``cells`` needs ``value, n, n_before, n_total``. No group is gathered: only the cells that hold
    a wanted rank survive, at most two per quantile.
    """
    hits = cells.select(
        *group, "value",
        F.col("n_before").alias("first"),
        (F.col("n_before") + F.col("n") - 1).alias("last"),
        F.inline(ranks_at(probabilities, F.col("n_total"))),
    ).where((F.col("first") <= F.col("lower") + 1) & (F.col("last") >= F.col("lower")))
    at_lower = (F.col("first") <= F.col("lower")) & (F.col("last") >= F.col("lower"))
    at_upper = (F.col("first") <= F.col("lower") + 1) & (F.col("last") >= F.col("lower") + 1)
    low = F.max(F.when(at_lower, F.col("value")))
    high = F.max(F.when(at_upper, F.col("value")))
    return hits.groupBy(*group, "q").agg(
        (low + F.max("fraction") * (F.coalesce(high, low) - low)).alias("quantile")
    )


def by_class(cells: DataFrame) -> DataFrame:
    """Split cells counted over both classes into one set of cells per class."""
    parts = ("n", "n_before", "n_total")
    positives = ("pos", "pos_before", "pos_total")
    one = F.struct(F.lit(1).alias("label"), *[F.col(y).alias(n) for n, y in zip(parts, positives)])
    zero = F.struct(F.lit(0).alias("label"), *[(F.col(n) - F.col(y)).alias(n) for n, y in zip(parts, positives)])
    return cells.select("series", "value", F.inline(F.array(zero, one))).where(F.col("n") > 0)
