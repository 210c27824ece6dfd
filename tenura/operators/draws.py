"""Multinomial draws: packed by blocks of row ids, added up into score cells.

Draw i of replicate b is the position ``hash60(b, i) mod n`` in the order of the row ids. Draws are never single rows:

1. A task draws a run of positions of one replicate, sorts them, and sends one packed record to each block of neighbouring
   row ids: counts, or offsets where they are fewer. Blocks end between row ids, so copies of an id share theirs.
2. A block meets its rows. Its records become one weight for each row and replicate, and these the weight sums of its
   score cells; the records of a score bucket are then added up. ``weight_cells`` walks the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tenura.operators.ranking import MAX_BUCKETS, SplitPoints, default_buckets, split_points, with_interval, with_order_codes
from tenura.operators.weight_cells import DRAWN, RECORD, SUMS, Strip, WeightCells, _groups, _starts, drawn_record, read_drawn
from tenura.session import shared_table

#: Draws of one replicate that a task sorts at once, weights of a block, numbers of a bucket and of a strip.
DRAWS_AT_ONCE, BLOCK_NUMBERS, BUCKET_NUMBERS, STRIP_NUMBERS = 1 << 24, 1 << 25, 1 << 25, 1 << 21
#: Codes of scores that have no place between split points.
NULL_CODE, NAN_CODE = -1, 1 << 30
PACKED = "block int, b int, width int, size int, data binary"

# Shifts, sines and word order of MD5 (RFC 1321).
_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORDS = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_BEGIN = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


# ---- positions ---------------------------------------------------------------------------------


def _md5_heads(message: np.ndarray, first: int, last: int) -> np.ndarray:
    """The first 60 bits of the MD5 of one-block messages that differ in words first to last only."""
    words = message.view("<u4")
    word = [np.ascontiguousarray(words[:, j]) if first <= j <= last else int(words[0, j]) for j in range(16)]
    a, b, c, d = (np.full(len(message), v, np.uint32) for v in _BEGIN)
    f, spare = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        w = word[_WORDS[i]]
        if isinstance(w, np.ndarray):
            np.add(f, w, out=f)
            w = 0
        np.add(f, np.uint32((_SINES[i] + w) & 0xFFFFFFFF), out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=spare)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, spare, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    high, low = (a + np.uint32(_BEGIN[0])).byteswap(), (b + np.uint32(_BEGIN[1])).byteswap()
    return (high.astype(np.uint64) << np.uint64(28)) | (low.astype(np.uint64) >> np.uint64(4))


def _tail_digits(width: int) -> np.ndarray:
    """The last ``width`` digits of ten to that power numbers in a row, as ASCII."""
    return (np.arange(10**width)[:, None] // 10 ** np.arange(width - 1, -1, -1) % 10 + 48).astype(np.uint8)


def positions(b: int, low: int, high: int, n: int) -> np.ndarray:
    """``hash60(b, i) mod n`` for i from low to high, up to 25,000 numbers of equal length at a time."""
    tails: dict[int, np.ndarray] = {}
    out = np.empty(high - low, np.uint32 if n <= 2**32 else np.uint64)
    at = low
    while at < high:
        length = len(str(at))
        tail = min(length, 5)
        if tail not in tails:
            tails[tail] = _tail_digits(tail)
        begin = at - at % 10**tail
        to = min(high, begin + 10**tail, at + 25_000)
        head = f"{b}:{str(at)[:-tail]}".encode()
        message = np.zeros((to - at, 64), np.uint8)
        message[:, : len(head)] = np.frombuffer(head, np.uint8)
        end = len(head) + tail
        message[:, len(head) : end] = tails[tail][at - begin : to - begin]
        message[:, end] = 0x80
        message[:, 56:58] = np.frombuffer((8 * end).to_bytes(2, "little"), np.uint8)
        out[at - low : to - low] = _md5_heads(message, len(head) // 4, (end - 1) // 4) % np.uint64(n)
        at = to
    return out


# ---- packed draws ------------------------------------------------------------------------------


def _packed_counts(offsets: np.ndarray, width: int) -> tuple[int, int, bytes]:
    """(bytes of a count, or 0 for offsets; numbers; data) of the sorted draws of a block of ``width`` positions."""
    if 4 * len(offsets) < width:
        return 0, len(offsets), pa.Codec("zstd", 1).compress(offsets.astype(np.uint64), asbytes=True)
    counts = np.bincount(offsets.astype(np.int64), minlength=width)
    kind = np.min_scalar_type(int(counts.max()))
    return kind.itemsize, width, pa.Codec("zstd", 1).compress(counts.astype(kind), asbytes=True)


def _counts(record: dict, width: int) -> np.ndarray:
    bytes_each = record["width"] or 8
    plain = np.frombuffer(pa.Codec("zstd").decompress(record["data"], bytes_each * record["size"]), f"u{bytes_each}")
    return plain.astype(np.int64) if record["width"] else np.bincount(plain.astype(np.int64), minlength=width)


@dataclass(frozen=True)
class Draws:
    """How often each row is drawn in each of B replicates of n draws, packed by blocks of row ids."""

    records: DataFrame
    points: SplitPoints
    blocks: int
    replicates: int
    row_id: str

    def dealt(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows and records by block. A number given by hand is kept: records are small, but stand for B weights a row."""
        parts = max(self.blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return _with_block(rows, self.row_id, self.points).repartition(parts, "block"), self.records.repartition(parts, "block")

    def long(self, df: DataFrame) -> DataFrame:
        """``b, row_id, w``: a row for each position that was drawn."""
        name, kind = self.row_id, df.schema[self.row_id].dataType.simpleString()
        rows, records = self.dealt(df.select(name))

        def work(rows: pa.Table, records: pa.Table) -> pa.Table:
            ids = rows.column(name).combine_chunks()
            ids = ids.take(pc.sort_indices(ids))
            tables = [pa.table([pa.array([], pa.int32()), ids[:0], pa.array([], pa.int64())], ["b", name, "w"])]
            for b, runs in groupby(records.sort_by("b").to_pylist() if len(ids) else [], key=lambda r: r["b"]):
                counts = sum(_counts(r, len(ids)) for r in runs)
                drawn = np.flatnonzero(counts)
                tables.append(pa.table([pa.array(np.full(len(drawn), b, np.int32)), ids.take(pa.array(drawn)), pa.array(counts[drawn])], ["b", name, "w"]))
            return pa.concat_tables(tables)

        return rows.groupBy("block").cogroup(records.groupBy("block")).applyInArrow(work, f"b int, `{name}` {kind}, w bigint")


def block_weights(ids: np.ndarray, records: pa.Table, replicates: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each row of a block in the weights, and the weights: a row for each id, a column for each replicate.

    Every copy of an id has the draws of all its copies.
    """
    order = np.argsort(ids, kind="stable")
    starts = _starts(ids[order])
    runs = np.diff(np.append(starts, len(ids)))
    place = np.empty(len(ids), np.int64)
    place[order] = np.repeat(np.arange(len(starts)), runs)
    by_replicate = np.zeros((replicates, len(starts)), np.uint16 if runs.max() < 1000 else np.uint32)
    for batch in records.to_batches(max_chunksize=64):
        for record in batch.to_pylist():
            counts = _counts(record, len(ids))
            by_replicate[record["b"]] += (counts if len(starts) == len(ids) else np.add.reduceat(counts, starts)).astype(by_replicate.dtype)
    return place, np.ascontiguousarray(by_replicate.T)


def _with_block(df: DataFrame, row_id: str, points: SplitPoints) -> DataFrame:
    """Rows that have an id, with the number of their block."""
    return with_interval(df.where(F.col(row_id).isNotNull()), row_id, points, "block").withColumn("block", F.coalesce("block", F.lit(-1)))


def multinomial_draws(df: DataFrame, replicates: int, row_id: str = "row_id") -> Draws:
    """n draws with replacement in each replicate, as packed records; no single draw is shuffled."""
    spark, n = df.sparkSession, df.count()
    ids = df.select(row_id)
    wide = max(1, BLOCK_NUMBERS // replicates)
    cores = spark.sparkContext.defaultParallelism
    points = split_points(ids, [row_id], min(MAX_BUCKETS, max(-(-n // wide), min(2 * cores, n // 4096), 2)))[row_id]
    # a row for each block: bounded by the number of split points
    sizes = {r["block"]: r["count"] for r in _with_block(ids, row_id, points).groupBy("block").count().collect()}
    blocks = np.array(sorted(sizes), np.int32)
    ends = np.cumsum([sizes[int(k)] for k in blocks], dtype=np.int64)
    widths = np.diff(ends, prepend=0)
    chunks = max(1, -(-n // DRAWS_AT_ONCE))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                b, chunk = divmod(unit, chunks)
                place = positions(b, chunk * DRAWS_AT_ONCE, min(n, (chunk + 1) * DRAWS_AT_ONCE), n)
                place.sort()
                cuts = [0, *np.searchsorted(place, ends).tolist()]  # positions of rows without an id come last
                hit = [k for k in range(len(blocks)) if cuts[k + 1] > cuts[k]]
                packed = [_packed_counts(place[cuts[k] : cuts[k + 1]] - place.dtype.type(ends[k] - widths[k]), int(widths[k])) for k in hit]
                width, size, data = zip(*packed, strict=True) if packed else ((), (), ())
                kinds = {"block": pa.int32(), "b": pa.int32(), "width": pa.int32(), "size": pa.int32(), "data": pa.binary()}
                columns = [blocks[hit], np.full(len(hit), b, np.int32), width, size, data]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    units = replicates * chunks if n else 0
    tasks = max(1, min(units, max(4 * cores, replicates * n // DRAWS_AT_ONCE)))
    return Draws(spark.range(0, units, 1, tasks).mapInArrow(draw, PACKED), points, len(blocks), replicates, row_id)


# ---- cells -------------------------------------------------------------------------------------


def _cells_of(series: int, code: np.ndarray, value: np.ndarray, positive: np.ndarray, place: np.ndarray, weights: np.ndarray) -> Iterator[tuple]:
    """Records of the cells of one score column in a block, a bucket at a time, in strips of bounded size."""
    replicates = weights.shape[1]
    order = np.lexsort((positive, -value, code))
    code, value, positive, place = code[order], value[order], positive[order], place[order]
    cell = np.concatenate([[True], (code[1:] != code[:-1]) | (value[1:] != value[:-1])])
    side = np.flatnonzero(cell | np.concatenate([[True], positive[1:] != positive[:-1]]))
    number = np.cumsum(cell) - 1
    first = np.flatnonzero(cell)
    per_strip = max(1, STRIP_NUMBERS // replicates)
    for at in range(0, len(first), per_strip):
        own = first[at : at + per_strip]
        a, z = own[0], first[at + per_strip] if at + per_strip < len(first) else len(code)
        sides = side[np.searchsorted(side, a) : np.searchsorted(side, z)]
        both = np.zeros((len(own), 2, replicates), np.uint32)
        # a cell of many rows is added up in runs of bounded size
        for run in range(a, z, per_strip):
            to = min(run + per_strip, z)
            inside = sides[(sides > run) & (sides < to)]
            starts = np.concatenate([[run], inside])
            both[number[starts] - at, positive[starts].astype(np.int64)] += np.add.reduceat(weights[place[run:to]], starts - run, axis=0, dtype=np.uint32)
        cuts = np.append(_starts(code[own]), len(own))
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield drawn_record(series, int(code[own[x]]), value[own[x:y]], both[x:y])


def _records(rows: list[tuple]) -> pa.Table:
    kinds = {"series": pa.int32(), "bucket": pa.int32(), "kind": pa.int32(), "size": pa.int32(), "data": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))


def _merged(replicates: int):
    """The records of a bucket as one run of cells, with the sums of all their vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (series, bucket), records in _groups(batches):
            parts = [read_drawn(r, replicates) for r in records]
            value = np.concatenate([v for v, _ in parts])
            both = np.concatenate([w for _, w in parts])
            del parts
            order = np.argsort(-value, kind="stable")
            starts = _starts(value[order])
            total = np.zeros((2, replicates), np.int64)
            per_strip = max(1, STRIP_NUMBERS // replicates)
            ends = np.append(starts[1:], len(order))
            at = 0
            while at < len(starts):
                to = max(at + 1, int(np.searchsorted(ends, starts[at] + per_strip, "right")))
                some = order[starts[at] : ends[to - 1]]
                sums = np.add.reduceat(both[some], starts[at:to] - starts[at], axis=0, dtype=np.int64)
                total += sums.sum(axis=0)
                yield from _records([drawn_record(series, bucket, value[order[starts[at:to]]], sums)]).to_batches()
                at = to
            yield from _records([(series, bucket, SUMS, 1, total.tobytes())]).to_batches()

    return work


def drawn_cells(df: DataFrame, probs: list[str], label: str, draws: Draws) -> WeightCells:
    """Cells of all score columns under the draws; labels are 0 and 1. Written, as metrics and curves read them often."""
    n = df.count()
    buckets = min(MAX_BUCKETS, max(default_buckets(df.sparkSession), -(-2 * n * draws.replicates // BUCKET_NUMBERS)))
    coded = with_order_codes(df.select(draws.row_id, *probs, F.col(label).cast("bigint").alias("y")), probs, split_points(df, probs, buckets))
    number = lambda c: F.col(c).cast("double")
    code = lambda c: F.when(F.col(c).isNull(), NULL_CODE).when(F.isnan(number(c)), NAN_CODE).otherwise(F.col(f"__code_{c}"))
    scores = [x for i, c in enumerate(probs) for x in (F.coalesce(F.nanvl(number(c), F.lit(0.0)), F.lit(0.0)).alias(f"v{i}"), code(c).cast("int").alias(f"c{i}"))]
    narrow = coded.select(draws.row_id, F.coalesce(F.col("y") == 1, F.lit(False)).alias("positive"), *scores)
    rows, records = draws.dealt(narrow)

    def meet(rows: pa.Table, records: pa.Table) -> pa.Table:
        if not rows.num_rows or not records.num_rows:
            return _records([])
        place, weights = block_weights(rows.column(name).to_numpy(), records, replicates)
        column = lambda name: rows.column(name).to_numpy()
        return pa.concat_tables([_records(list(_cells_of(i, column(f"c{i}"), column(f"v{i}") + 0.0, column("positive"), place, weights))) for i in range(count)])

    count, name, replicates = len(probs), draws.row_id, draws.replicates
    met = rows.groupBy("block").cogroup(records.groupBy("block")).applyInArrow(meet, RECORD)
    key = ["series", "bucket"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = met.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(_merged(replicates), RECORD)
    return WeightCells(shared_table(merged), tuple(probs), replicates)


def cell_table(cells: WeightCells, kinds: dict[str, str]) -> DataFrame:
    """``b, series, bucket, value, n, pos`` of every drawn cell, with what ranks before it and the totals of its replicate."""
    names = ["n", "pos", "n_before", "pos_before", "n_total", "pos_total"]

    def walk(series: int, bucket: int, strips: Iterator[Strip], total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in strips:
            n = s.neg + s.pos
            cell, b = np.nonzero(n)
            value = pa.nulls(len(b), pa.float64()) if bucket == NULL_CODE else pa.array(np.full(len(b), np.nan) if bucket == NAN_CODE else s.value[cell])
            counts = [n[cell, b], s.pos[cell, b], (s.neg_before + s.pos_before)[cell, b], s.pos_before[cell, b], total.sum(axis=0)[b], total[1][b]]
            heads = [pa.array(b.astype(np.int32)), pa.array(np.full(len(b), series, np.int32)), pa.array(np.full(len(b), bucket, np.int32)), value]
            yield pa.RecordBatch.from_arrays([*heads, *map(pa.array, counts)], ["b", "series", "bucket", "value", *names])

    table = cells._walked(walk, "b int, series int, bucket int, value double, " + ", ".join(f"{x} bigint" for x in names))
    return cells.named(table).withColumn("value", F.col("value").cast(kinds[cells.series[0]]))
