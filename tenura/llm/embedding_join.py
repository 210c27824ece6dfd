"""Near-duplicate vectors by cosine, compared in tiles along the principal directions.

Vectors are scaled to length one, equal ones become one class, and all are turned to the principal axes of their second
moments, strongest first. A tile pair first multiplies the leading dimensions only. What the other dimensions can add is
at most the product of the two suffix norms, so pairs that cannot reach the threshold stop there, and only survivors get
the next dimensions. Vectors are cut into blocks along the first axis; blocks farther apart on it than the threshold
allows never meet. A task has two blocks and returns counts of links and links that join components, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import sorted_groups, written
from .components import components

THRESHOLD = 0.95
#: Vectors of a block (two are held in a task), of a tile, and the dimensions after which bounds are tested.
BLOCK, TILE, STEPS = 6000, 1000, (16, 32)
#: What rounding may take from or add to a bound.
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(1, keepdims=True)  # so squares of very large or small numbers stay finite
    rows = rows / largest
    return rows / np.sqrt((rows**2).sum(1, keepdims=True))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            unit = _unit(_matrix(batch.column("vector")))
            part = unit.T @ unit
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_pydict({"place": np.arange(total.size), "value": total.ravel()})


def _turned(axes):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _unit(_matrix(batch.column("vector"))) @ axes.value
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("size"), flat, pa.array(rows[:, 0].copy())], ["id", "size", "vector", "first"])

    return work


def _near(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, steps: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y whose product reaches the threshold; sx and sy are the suffix norms behind each step."""
    k = steps[0]
    a, b = np.nonzero(x[:, :k] @ y[:, :k].T + np.outer(sx[:, 0], sy[:, 0]) >= threshold - SLACK)
    total = np.einsum("ij,ij->i", x[a, :k], y[b, :k])
    for n, (low, high) in enumerate(zip(steps, [*steps[1:], x.shape[1]], strict=True), 1):
        total = total + np.einsum("ij,ij->i", x[a, low:high], y[b, low:high])
        rest = sx[a, n] * sy[b, n] if n < len(steps) else 0.0
        good = total + rest >= threshold - (SLACK if n < len(steps) else 0.0)
        a, b, total = a[good], b[good], total[good]
    return a, b


def _compare(threshold: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["i", "j"]):
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            side, ids, size = (group.column(c).to_numpy() for c in ("side", "id", "size"))
            rows = _matrix(group.column("vector").combine_chunks())
            order = np.lexsort((rows[:, 0], side))
            side, ids, size, rows = side[order], ids[order], size[order], rows[order]
            steps = [k for k in STEPS if k < rows.shape[1]] or [max(1, rows.shape[1] // 2)]
            squares = rows**2
            suffix = np.sqrt(np.maximum(0, np.stack([squares[:, k:].sum(1) for k in steps], 1)))
            parts = [(s, e) for c in np.unique(side) for lo, hi in [(np.searchsorted(side, c), np.searchsorted(side, c, "right"))] for s, e in ((k, min(k + TILE, hi)) for k in range(lo, hi, TILE))]
            far = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK  # the largest distance of linked vectors
            weight = np.zeros(len(ids), np.int64)
            root = np.arange(len(ids))
            links: list[tuple[int, int]] = []
            for p, (a0, a1) in enumerate(parts):
                for b0, b1 in parts[p:]:
                    if i != j and side[a0] == side[b0] or rows[b0, 0] - rows[a1 - 1, 0] > far or rows[a0, 0] - rows[b1 - 1, 0] > far:
                        continue
                    a, b = _near(rows[a0:a1], rows[b0:b1], suffix[a0:a1], suffix[b0:b1], steps, threshold)
                    a, b = a + a0, b + b0
                    if a0 == b0:
                        a, b = a[a < b], b[a < b]
                    np.add.at(weight, a, size[b])
                    np.add.at(weight, b, size[a])
                    open_ = root[a] != root[b]
                    while open_.any():
                        a, b = a[open_], b[open_]
                        links.append((int(ids[a[0]]), int(ids[b[0]])))
                        root[root == root[b[0]]] = root[a[0]]
                        open_ = root[a] != root[b]
            found = np.flatnonzero(weight)
            n = len(found) + len(links)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[found], np.array([x for x, _ in links], np.int64)]), pa.int64()),
                pa.array([None] * len(found) + [y for _, y in links], pa.int64()),
                pa.array(np.concatenate([weight[found], np.zeros(n - len(found), np.int64)]), pa.int64()),
            ], ["a", "b", "links"])

    return work


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors link only
    with others of their length. Equal rows are separate vectors. A null id links with nothing. An empty table gives an
    empty table; other columns are not read.
    """
    source = vectors.select(vectors[id_column].cast("long").alias("id"), vectors[vector_column].cast("array<double>").alias("vector"))
    sound = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = source.where(sound & F.col("id").isNotNull()).withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    spark = vectors.sparkSession
    classes = written(usable.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("size")))
    found = None
    for (length,) in classes.select(F.size("vector")).distinct().orderBy(F.size("vector")).collect():
        some = classes.where(F.size("vector") == length)
        values = some.select("vector").mapInArrow(_moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
        moments = np.array([r.value for r in values]).reshape(length, length)
        axes = spark.sparkContext.broadcast(np.ascontiguousarray(np.linalg.eigh(moments)[1][:, ::-1]))
        turned = written(some.mapInArrow(_turned(axes), "id long, size long, vector array<double>, first double"))
        part = _block_pairs(turned, threshold).mapInArrow(_compare(threshold), "a long, b long, links long")
        part = written(part)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return source.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    # a link to a lower id may be found from either side
    parts = components(found.where("b is not null").select("a", "b"))
    named = classes.select("vector", "id", "size").join(counts, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    keyed = source.withColumn("key", F.when(sound & F.col("id").isNotNull(), F.transform("vector", lambda x: x + 0.0)))
    out = keyed.join(named.withColumnRenamed("vector", "key"), "key", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _block_pairs(turned: DataFrame, threshold: float) -> DataFrame:
    """Every vector once for each pair of blocks in which its block may have links."""
    n = turned.count()
    blocks = max(1, -(-n // BLOCK))
    cuts = turned.agg(F.percentile_approx("first", [k / blocks for k in range(1, blocks)], 10_000)).first()[0] if blocks > 1 else []
    cuts = sorted(set(cuts))
    block = F.lit(0)
    for k, cut in enumerate(cuts):
        block = F.when(F.col("first") >= cut, k + 1).otherwise(block)
    # equal first coordinates share a block; where that makes it too large, it is cut by id
    placed = turned.withColumn("range", block)
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"), F.min("first").alias("low"), F.max("first").alias("high")).orderBy("range").collect()
    far = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    names, ranges = {}, []
    for r in sizes:
        names[r["range"]] = (len(ranges), -(-r.n // (2 * BLOCK)))
        ranges += [(r.low, r.high)] * names[r["range"]][1]
    meets = [[b for b in range(len(ranges)) if ranges[b][0] - ranges[a][1] <= far and ranges[a][0] - ranges[b][1] <= far] for a in range(len(ranges))]
    spark = turned.sparkSession
    base = spark.createDataFrame([(k, first, parts) for k, (first, parts) in names.items()], "range int, base int, parts int")
    others = spark.createDataFrame([(a, m) for a, m in enumerate(meets)], "side int, others array<int>")
    rows = placed.join(F.broadcast(base), "range").withColumn("side", F.col("base") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.join(F.broadcast(others), "side").withColumn("other", F.explode("others"))
    pairs = rows.select(F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "size", "vector")
    return pairs.repartition("i", "j").sortWithinPartitions("i", "j")
