"""Poisson bootstrap on mergeable weight vectors.

Every row has a Poisson(1) weight in each of B replicates, a pure function of row id and replicate. A score cell is one
distinct score with two vectors of B weight sums, one for each class; vectors of the same cell add up.

1. A task turns its rows into cells, some ten thousand rows at a time, for all score columns from the same weights. Scores
   are cut at approximate quantiles into buckets; a score that is itself a quantile has a bucket of its own. The cells of
   a bucket leave the task as one packed record: vectors where a score has enough rows for them to be smaller, else the
   row ids, whose weights can be drawn again. Bucket sums of the vectors leave the task once. So no row is shuffled, a
   score of any frequency is one vector per record, and continuous scores do not become B numbers a row.
2. The bucket sums are added up in score order: for each bucket the vectors of what ranks before it, and the totals.
3. A task reads the records of a bucket, best score first, in strips of bounded size with the running vectors carried
   along, and adds up the terms of the metrics or interpolates the curves of all replicates at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tenura.functions.expressions import POISSON_ONE_CDF
from tenura.operators.ranking import default_buckets, split_points
from tenura.session import shared_table

# Modulus, multipliers and seed of the weight hash.
MODULUS = 2**31 - 1
ROW_STEP, REPLICATE_STEP, HIGH_STEP, SECOND_STEP, WEIGHT_SEED = 48271, 69621, 40692, 16807, 42

#: Bytes of drawn weights held at once, and numbers of a strip of cells.
WEIGHT_BYTES, STRIP_NUMBERS = 48 << 20, 1 << 20
#: Rows whose weights add up within two bytes (a weight is at most 18).
FEW = 3500
SUMS, VECTORS, ROWS, BEFORE, DRAWN = 0, 1, 2, 3, 4
RECORD = "series int, bucket int, kind int, size int, data binary"


# ---- weights -----------------------------------------------------------------------------------


def _fold(x: np.ndarray, spare: np.ndarray, times: int = 2) -> None:
    """x modulo the modulus, in place, up to one multiple: the modulus is a power of two less one. x is at most 2^62."""
    for _ in range(times):
        np.bitwise_and(x, np.uint64(MODULUS), out=spare)
        np.right_shift(x, np.uint64(31), out=x)
        np.add(x, spare, out=x)


def _fifth_power(x: np.ndarray, square: np.ndarray, spare: np.ndarray) -> None:
    """A permutation of the residues, since 5 does not divide the modulus minus one; in place."""
    np.multiply(x, x, out=square)
    _fold(square, spare)
    np.multiply(square, square, out=square)
    _fold(square, spare)
    np.multiply(x, square, out=x)
    _fold(x, spare)


def _weight_steps() -> tuple[np.ndarray, np.ndarray]:
    """The least residue of each weight from 1 on, and the weight by the residue's leading 16 bits (255: not yet sure)."""
    edges = []
    for c in POISSON_ONE_CDF:
        least = int(c * MODULUS)
        while least and (least - 1) / MODULUS >= c:
            least -= 1
        while least / MODULUS < c:
            least += 1
        edges.append(least)
    steps = np.array(edges, np.int64)
    low = np.arange(1 << 16) << 15
    first, last = np.searchsorted(steps, low, "right"), np.searchsorted(steps, low + (1 << 15) - 1, "right")
    return steps, np.where(first == last, first, 255).astype(np.uint8)


_STEPS, _BY_HEAD = _weight_steps()


def weight_matrix(row_id: np.ndarray, replicates: int, first: int = 0) -> np.ndarray:
    """Poisson(1) weights: a row for each id, a column for each replicate from ``first`` on.

    A weight is a pure function of id and replicate. Small whole numbers of two bytes: sums of a few thousand rows fit.
    """
    out = np.empty((replicates, len(row_id)), np.uint16)
    for at in range(0, len(row_id), 4096):  # arrays that stay in the processor's cache
        ids = row_id[at : at + 4096].astype(np.int64)
        low = (ids % MODULUS * ROW_STEP % MODULUS).astype(np.uint64)
        high = (ids // MODULUS * HIGH_STEP % MODULUS).astype(np.uint64)
        x, square, spare = (np.empty(len(ids), np.uint64) for _ in range(3))
        for b in range(first, first + replicates):
            np.add(low, np.uint64(((b + 1) * REPLICATE_STEP + WEIGHT_SEED) % MODULUS), out=x)
            _fold(x, spare, 1)
            _fifth_power(x, square, spare)
            np.add(x, high, out=x)
            np.add(x, np.uint64((b + 1) * SECOND_STEP % MODULUS), out=x)
            _fold(x, spare, 1)
            _fifth_power(x, square, spare)
            np.subtract(x, np.uint64(MODULUS), out=x, where=x >= np.uint64(MODULUS))
            own = _BY_HEAD[x >> np.uint64(15)]
            unsure = np.flatnonzero(own == 255)
            own[unsure] = np.searchsorted(_STEPS, x[unsure].astype(np.int64), "right")
            out[b - first, at : at + len(ids)] = own
    return np.ascontiguousarray(out.T)


def poisson_weights(row_id: np.ndarray, b: int) -> np.ndarray:
    """The weights of one replicate."""
    return weight_matrix(row_id, 1, b)[:, 0]


def _cell_sums(weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, at most a few thousand together."""
    return np.add.reduceat(weights, starts, axis=0).astype(np.int64) if len(starts) else np.zeros((0, weights.shape[1]), np.int64)


# ---- records -----------------------------------------------------------------------------------


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _packed(edges: list[np.ndarray], replicates: int):
    """Cells of a task's rows by (series, bucket), and once for each the sums of all their vectors."""
    per_flush = max(1000, WEIGHT_BYTES // (2 * replicates))

    def codes(value: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        at = np.searchsorted(cuts, value, "right")
        on = (at > 0) & (cuts[np.maximum(at - 1, 0)] == value) if len(cuts) else np.zeros(len(value), bool)
        return 2 * at - on

    def flush(ids: np.ndarray, y: np.ndarray, scores: list[np.ndarray], sums: dict) -> Iterator[tuple]:
        weights = weight_matrix(ids, replicates)
        for series, score in enumerate(scores):
            known = np.flatnonzero(~np.isnan(score))
            if not len(known):
                continue
            value, bucket = score[known] + 0.0, codes(score[known], edges[series])
            order = np.lexsort((1 - y[known], -value, bucket))
            rows, value, bucket = known[order], value[order], bucket[order]
            positive = y[rows] == 1
            at = _starts(bucket)
            for a, z in zip(at, np.append(at[1:], len(rows)), strict=True):
                key = (series, int(bucket[a]))
                own, own_value, own_pos = rows[a:z], value[a:z], positive[a:z]
                total = sums.setdefault(key, np.zeros((2, replicates), np.int64))
                for side, some in enumerate((own[~own_pos], own[own_pos])):
                    for run in range(0, len(some), FEW):
                        total[side] += weights[some[run : run + FEW]].sum(axis=0, dtype=np.uint16)
                cells = _starts(own_value)
                counts = np.diff(np.append(cells, len(own)))
                often = counts * 17 > 8 + 8 * replicates
                heavy = np.repeat(often, counts)
                if often.any():
                    w, p = weights[own[heavy]].astype(np.uint32), own_pos[heavy]
                    first = _starts(own_value[heavy])
                    pos = _cell_sums(w * p[:, None], first)
                    both = np.stack([_cell_sums(w, first) - pos, pos], axis=1).astype(np.uint32)
                    yield (*key, VECTORS, len(first), own_value[heavy][first].tobytes() + both.tobytes())
                if not often.all():
                    light = ~heavy
                    yield (*key, ROWS, int(light.sum()), own_value[light].tobytes() + ids[own[light]].tobytes() + own_pos[light].astype(np.uint8).tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, sums = 0, {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int32()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["series", "bucket", "kind", "size", "data"])

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            columns = [rows.column(i).to_numpy() for i in range(rows.num_columns)]
            return out(list(flush(columns[0], columns[1], [c.astype(float) for c in columns[2:]], sums)))

        for batch in batches:
            for at in range(0, batch.num_rows, per_flush):
                held.append(batch.slice(at, per_flush))
                size += held[-1].num_rows
                if size >= per_flush:
                    yield done()
                    held, size = [], 0
        if size:
            yield done()
        if sums:
            yield out([(*key, SUMS, 1, total.astype(np.int64).tobytes()) for key, total in sums.items()])

    return work


def drawn_record(series: int, bucket: int, value: np.ndarray, both: np.ndarray) -> tuple:
    """A record of cells with vectors of given sums, in as few bytes a number as they need."""
    kind = np.min_scalar_type(int(both.max(initial=0)))
    plain = value.tobytes() + both.astype(kind).tobytes()
    return series, bucket, DRAWN, len(value), bytes([kind.itemsize]) + pa.Codec("zstd", 1).compress(plain, asbytes=True)


def read_drawn(record: dict, replicates: int) -> tuple[np.ndarray, np.ndarray]:
    """The scores of such a record, and their vectors."""
    n, each = record["size"], record["data"][0]
    plain = pa.Codec("zstd").decompress(record["data"][1:], n * (8 + 2 * replicates * each))
    return np.frombuffer(plain, np.float64, n), np.frombuffer(plain, f"u{each}", offset=8 * n).reshape(n, 2, replicates)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """The records of each (series, bucket) of a sorted partition."""
    key, held = None, []
    for batch in batches:
        for record in batch.to_pylist():
            own = record["series"], record["bucket"]
            if own != key and held:
                yield key, held
                held = []
            key = own
            held.append(record)
    if held:
        yield key, held


def _summed(replicates: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (series, bucket), records in _groups(batches):
            total = sum(np.frombuffer(r["data"], np.int64) for r in records)
            yield pa.RecordBatch.from_pydict({"series": pa.array([series], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "kind": pa.array([SUMS], pa.int32()), "size": pa.array([1], pa.int32()), "data": [total.tobytes()]})

    return work


def _before(replicates: int):
    """For each bucket of a series, best first: what ranks before it, and the totals (negatives, positives)."""

    def emit(series: int, buckets: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
        each = np.stack(sums)
        total = each.sum(axis=0)
        earlier = np.cumsum(each, axis=0) - each
        data = [np.stack([*e, *total]).tobytes() for e in earlier]
        n = len(buckets)
        return pa.RecordBatch.from_arrays([pa.array([series] * n, pa.int32()), pa.array(buckets, pa.int32()), pa.array([BEFORE] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(data, pa.binary())], ["series", "bucket", "kind", "size", "data"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, buckets, sums = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["series"] != series and buckets:
                    yield emit(series, buckets, sums)
                    buckets, sums = [], []
                series = r["series"]
                buckets.append(r["bucket"])
                sums.append(np.frombuffer(r["data"], np.int64).reshape(2, replicates))
        if buckets:
            yield emit(series, buckets, sums)

    return work


@dataclass(frozen=True)
class WeightCells:
    """Packed cells of some score columns under B Poisson replicates."""

    records: DataFrame
    series: tuple[str, ...]
    replicates: int

    def _walked(self, walk: Callable, schema: str) -> DataFrame:
        """Run ``walk(series, bucket, strips, state)``, which returns batches, over every bucket, best score first."""
        replicates, key = self.replicates, ["series", "bucket"]
        # a number given by hand is kept: records are small in bytes, but each stands for B weights a row
        parts = int(self.records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        summed = self.records.where(F.col("kind") == SUMS).repartition(*key).sortWithinPartitions(*key).mapInArrow(_summed(replicates), RECORD)
        # a row for each bucket: bounded by the number of split points
        ahead = summed.repartition("series").sortWithinPartitions("series", F.desc("bucket")).mapInArrow(_before(replicates), RECORD)
        cells = self.records.where(F.col("kind") != SUMS).unionByName(ahead)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (series, bucket), records in _groups(batches):
                before = next(np.frombuffer(r["data"], np.int64).reshape(4, replicates) for r in records if r["kind"] == BEFORE)
                out = walk(series, bucket, _strips(records, before[:2], replicates), before[2:])
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out

        return cells.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(work, schema)

    def named(self, df: DataFrame) -> DataFrame:
        """The number of a series replaced by its name."""
        names = F.array(*[F.lit(s) for s in self.series])
        return df.withColumn("series", F.get(names, F.col("series")))


def weight_cells(df: DataFrame, probs: list[str], label: str, replicates: int, *, row_id: str = "row_id") -> WeightCells:
    """Cells of all score columns; NULL and NaN scores drop out. Written, as metrics and curves read them twice."""
    points = split_points(df, probs, default_buckets(df.sparkSession))
    edges = [np.array(points[c].edges, np.float64) for c in probs]
    narrow = df.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(label).cast("int").alias("y"), *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"s{i}") for i, c in enumerate(probs)])
    return WeightCells(shared_table(narrow.mapInArrow(_packed(edges, replicates), RECORD)), tuple(probs), replicates)


@dataclass
class Strip:
    """Cells in descending order of score; all arrays are cells by replicates."""

    value: np.ndarray
    neg: np.ndarray
    pos: np.ndarray
    neg_before: np.ndarray
    pos_before: np.ndarray


def _strips(records: list[dict], before: np.ndarray, replicates: int) -> Iterator[Strip]:
    values, ids, pos = [], [], []
    cells, vectors = [np.zeros(0)], [np.zeros((0, 2, replicates), np.uint32)]
    for r in records:
        n, data = r["size"], r["data"]
        if r["kind"] == ROWS:
            values.append(np.frombuffer(data, np.float64, n))
            ids.append(np.frombuffer(data, np.int64, n, 8 * n))
            pos.append(np.frombuffer(data, np.uint8, n, 16 * n))
        elif r["kind"] == VECTORS:
            cells.append(np.frombuffer(data, np.float64, n))
            vectors.append(np.frombuffer(data, np.uint32, offset=8 * n).reshape(n, 2, replicates))
        elif r["kind"] == DRAWN:
            own, both = read_drawn(r, replicates)
            cells.append(own)
            vectors.append(both)
    value = np.concatenate([np.zeros(0), *values])
    ids, pos = np.concatenate([np.zeros(0, np.int64), *ids]), np.concatenate([np.zeros(0, np.uint8), *pos])
    order = np.argsort(-value, kind="stable")
    value, ids, pos = value[order], ids[order], pos[order]
    cells, vectors = np.concatenate(cells), np.concatenate(vectors)
    order = np.argsort(-cells, kind="stable")
    cells, vectors = cells[order], vectors[order]
    every = -np.unique(-np.concatenate([value, cells]))
    neg_before, pos_before = before[0].copy(), before[1].copy()
    per_strip = min(FEW, max(1, STRIP_NUMBERS // replicates))
    for at in range(0, len(every), per_strip):
        own = every[at : at + per_strip]
        neg_sum, pos_sum = np.zeros((len(own), replicates), np.int64), np.zeros((len(own), replicates), np.int64)
        # a strip bounds the cells; rows of equal scores are drawn in runs of bounded size as well
        a, z = (int(np.searchsorted(-value, -own[k], side)) for k, side in ((0, "left"), (-1, "right")))
        for run in range(a, z, per_strip):
            to = min(run + per_strip, z)
            weights = weight_matrix(ids[run:to], replicates)
            first = _starts(value[run:to])
            place = np.searchsorted(-own, -value[run:to][first])
            positive = _cell_sums(weights * pos[run:to, None].astype(np.uint16), first)
            pos_sum[place] += positive
            neg_sum[place] += _cell_sums(weights, first) - positive
        a, z = (int(np.searchsorted(-cells, -own[k], side)) for k, side in ((0, "left"), (-1, "right")))
        if z > a:
            first = _starts(cells[a:z])
            both = np.add.reduceat(vectors[a:z], first, axis=0, dtype=np.int64)
            place = np.searchsorted(-own, -cells[a:z][first])
            neg_sum[place] += both[:, 0]
            pos_sum[place] += both[:, 1]
        neg_upto, pos_upto = np.cumsum(neg_sum, axis=0) + neg_before, np.cumsum(pos_sum, axis=0) + pos_before
        yield Strip(own, neg_sum, pos_sum, neg_upto - neg_sum, pos_upto - pos_sum)
        neg_before, pos_before = neg_upto[-1], pos_upto[-1]


# ---- metrics and curves ------------------------------------------------------------------------


def replicate_sums(cells: WeightCells, cut: float = 0.5) -> DataFrame:
    """``series, b, p, q, won, ap, tp, fp``: the sums that ranking and threshold metrics are made of."""
    names = ("won", "ap", "tp", "fp")

    def walk(series: int, bucket: int, strips: Iterator[Strip], total: np.ndarray) -> pa.RecordBatch:
        sums = np.zeros((4, total.shape[1]))
        for s in strips:
            tp = s.pos_before + s.pos
            sums[0] += (s.neg * (s.pos_before + s.pos / 2.0)).sum(axis=0)
            sums[1] += (s.pos * tp / np.maximum(tp + s.neg_before + s.neg, 1)).sum(axis=0)
            above = s.value > cut
            sums[2] += s.pos[above].sum(axis=0)
            sums[3] += s.neg[above].sum(axis=0)
        n = total.shape[1]
        columns = [pa.array(np.full(n, series, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(total[1].astype(float)), pa.array(total[0].astype(float)), *map(pa.array, sums)]
        return pa.RecordBatch.from_arrays(columns, ["series", "b", "p", "q", *names])

    terms = cells._walked(walk, "series int, b int, p double, q double, " + ", ".join(f"{n} double" for n in names))
    whole = terms.groupBy("series", "b").agg(F.max("p").alias("p"), F.max("q").alias("q"), *[F.sum(n).alias(n) for n in names])
    return cells.named(whole)


def _grid_hits(low: np.ndarray, high: np.ndarray, scale: np.ndarray, steps: np.ndarray | int) -> tuple[np.ndarray, ...]:
    """Grid numbers i with low/scale <= i/steps < high/scale: cell, replicate and number of each."""
    first = -(-(low * steps) // scale)
    last = -(-(high * steps) // scale) - 1
    cell, b = np.nonzero(last >= first)
    lowest, counts = first[cell, b], (last - first + 1)[cell, b]
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lowest, counts)
    return np.repeat(cell, counts), np.repeat(b, counts), number


def _curve(series: int, parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch | None:
    if not parts:
        return None
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    kinds = [np.int32, np.int64] + [np.float64] * (len(names) - 2)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), series, np.int32)), *[pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)]], ["series", *names])


def _both_classes(total: np.ndarray) -> np.ndarray:
    return (total[0] > 0) & (total[1] > 0)


def roc_curves(cells: WeightCells, points: int) -> DataFrame:
    """``b, series, grid, tpr`` of each replicate on an even false-positive grid."""
    steps = points - 1

    def walk(series: int, bucket: int, strips: Iterator[Strip], total: np.ndarray) -> pa.RecordBatch | None:
        valid, parts = _both_classes(total), []
        scale = np.maximum(total[0], 1)
        for s in strips:
            low, high = s.neg_before, np.where(valid, s.neg_before + s.neg, s.neg_before)
            cell, b, grid = _grid_hits(low, high, scale, steps)
            along = (grid * total[0][b] / float(steps) - low[cell, b]) / s.neg[cell, b]
            parts.append((b, grid, (s.pos_before[cell, b] + s.pos[cell, b] * along) / total[1][b]))
            # the curve ends at (1, 1), where the last negative has been passed
            ends = np.unique(np.nonzero((high == total[0]) & (s.neg > 0) & valid)[1])
            parts.append((ends, np.full(len(ends), steps), np.ones(len(ends))))
        return _curve(series, parts, ["b", "grid", "tpr"])

    return cells.named(cells._walked(walk, "series int, b int, grid long, tpr double"))


def pr_curves(cells: WeightCells, points: int) -> DataFrame:
    """``b, series, grid, precision`` of each replicate on an even recall grid, behind the point (0, 1).

    The points are the cells with positives. A bucket does not know the last point before it, so its first cell and the
    end it leaves are completed from a row for each bucket and replicate.
    """
    steps = points - 1
    columns = ["b", "grid", "kind", "bucket", "pos_before", "pos", "all_pos", "here", "precision"]

    def walk(series: int, bucket: int, strips: Iterator[Strip], total: np.ndarray) -> pa.RecordBatch | None:
        valid, parts = _both_classes(total), []
        scale = np.maximum(total[1], 1)
        replicates = total.shape[1]
        end = np.full(replicates, np.nan)

        def add(kind: int, b, grid, low, pos, here, value) -> None:
            n = len(b)
            parts.append((b, grid, np.full(n, kind), np.full(n, bucket), low, pos, total[1][b], here, value))

        for s in strips:
            tp = s.pos_before + s.pos
            here = tp / np.maximum(tp + s.neg_before + s.neg, 1)
            grown = (s.pos > 0) & valid
            # the precision of the last cell with positives above each cell, or what the strip began with
            last = np.maximum.accumulate(np.where(grown, np.arange(len(here))[:, None], -1), axis=0)
            above = np.vstack([np.full(replicates, -1), last[:-1]])
            previous = np.where(above >= 0, np.take_along_axis(here, np.maximum(above, 0), axis=0), end)
            first = grown & np.isnan(previous)
            cell, b = np.nonzero(first)
            add(1, b, np.zeros(len(b)), s.pos_before[cell, b], s.pos[cell, b], here[cell, b], np.zeros(len(b)))
            inner = grown & ~first
            cell, b, grid = _grid_hits(s.pos_before, np.where(inner, tp, s.pos_before), scale, steps)
            along = (grid * total[1][b] / float(steps) - s.pos_before[cell, b]) / s.pos[cell, b]
            add(0, b, grid, s.pos_before[cell, b], s.pos[cell, b], here[cell, b], previous[cell, b] + (here[cell, b] - previous[cell, b]) * along)
            cell, b = np.nonzero(inner & (tp == total[1]))
            add(0, b, np.full(len(b), steps), s.pos_before[cell, b], s.pos[cell, b], here[cell, b], here[cell, b])
            end = np.where(last[-1] >= 0, np.take_along_axis(here, np.maximum(last[-1:], 0), axis=0)[0], end)
        b = np.flatnonzero(~np.isnan(end))
        add(2, b, np.zeros(len(b)), np.zeros(len(b)), np.zeros(len(b)), end[b], np.zeros(len(b)))
        return _curve(series, parts, columns)

    walked = shared_table(cells._walked(walk, "series int, b int, grid long, " + ", ".join(f"{c} double" for c in columns[2:])))
    keys = ["series", "b"]
    earlier = Window.partitionBy(*keys).orderBy(F.desc("bucket"))
    ends = walked.where(F.col("kind") == 2).select(*keys, "bucket", F.coalesce(F.lag("here").over(earlier), F.lit(1.0)).alias("carried"))
    opened = walked.where(F.col("kind") == 1).join(ends, [*keys, "bucket"])
    tp = F.col("pos_before") + F.col("pos")
    low, high = F.ceil(F.col("pos_before") * steps / F.col("all_pos")), F.ceil(tp * steps / F.col("all_pos")) - 1
    grid = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    last = F.when(tp == F.col("all_pos"), F.array(F.lit(steps).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    opened = opened.withColumn("grid", F.explode(F.concat(grid, last)))
    along = (F.col("grid") * F.col("all_pos") / F.lit(float(steps)) - F.col("pos_before")) / F.col("pos")
    completed = opened.select(*keys, "grid", (F.col("carried") + (F.col("here") - F.col("carried")) * along).alias("precision"))
    return cells.named(walked.where(F.col("kind") == 0).select(*keys, "grid", "precision").unionByName(completed))


def gain_curves(cells: WeightCells, points: int) -> DataFrame:
    """``b, series, grid, captured`` percent at even positions; equal scores share their positives evenly."""

    def walk(series: int, bucket: int, strips: Iterator[Strip], total: np.ndarray) -> pa.RecordBatch | None:
        valid, parts = _both_classes(total), []
        step = np.maximum(total.sum(axis=0) // points, 1)
        for s in strips:
            low, n = s.pos_before + s.neg_before, s.pos + s.neg
            cell, b, grid = _grid_hits(low, np.where(valid, low + n, low), step, 1)
            place = grid * step[b] + 1 - low[cell, b]
            parts.append((b, grid, (s.pos_before[cell, b] + s.pos[cell, b] * place / n[cell, b]) / total[1][b] * 100.0))
        return _curve(series, parts, ["b", "grid", "captured"])

    return cells.named(cells._walked(walk, "series int, b int, grid long, captured double"))
