"""Shared helpers of the corpus operators: table access, Arrow batches cut to bounded pieces, lineage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that a Python task handles at once (a single longer text is handled alone).
PIECE_BYTES = 1 << 20
#: Bits of a chunk in which a set of bits is made.
CHUNK_BITS = 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def large_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array with 64-bit offsets; null becomes the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Every batch cut into runs of rows of at most ``limit`` bytes of text, with their texts; only a run is copied.

    What a partition's rows have taken is given back to the machine when they end, as Python workers serve many stages.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))])
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), large_strings(column.slice(at, to - at))
            at = to
    give_back()


def give_back() -> None:
    """Return free memory of Arrow and of the C library, where that can be asked for it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each begins (one more entry than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def per_row_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that spark.checkpoint.dir names, which all executors share.

    Where none is named, a session within one process (local master) gets one of its own; a cluster is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("Name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tenura-"))
        named = context.getCheckpointDir()
    return f"{named.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: the table as written to the shared folder. It survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Remove a table made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """The rows labels are never learned from: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bit_set(slots: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, packed from the lowest, of the numbers in ``slot``; made in chunks of 64 KB by tasks."""
    chunk_bits = min(bits, CHUNK_BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["chunk"]):
            own = np.zeros(1 << chunk_bits, bool)
            own[group.column("slot").to_numpy() & ((1 << chunk_bits) - 1)] = True
            yield pa.RecordBatch.from_arrays([group.column("chunk")[:1].combine_chunks(), pa.array([np.packbits(own, bitorder="little").tobytes()])], ["chunk", "bits"])

    dealt = slots.select("slot").withColumn("chunk", F.shiftright("slot", chunk_bits)).repartition("chunk").sortWithinPartitions("chunk")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in dealt.mapInArrow(work, "chunk long, bits binary").toLocalIterator():
        own = np.frombuffer(r["bits"], np.uint8)
        out[r["chunk"] * len(own) : (r["chunk"] + 1) * len(own)] = own
    return out


def in_bit_set(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    slot = slot.astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) > 0


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of a partition that is sorted by the keys, as one table; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        cuts = [*np.flatnonzero(change), batch.num_rows]
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if cut < batch.num_rows and held:
                yield pa.Table.from_batches(held)
                held = []
            at = cut
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
