"""Benchmark decontamination by the q-gram lemma.

Texts are compared in lower case with white space runs as one space, as UTF-8 bytes. An item of m bytes may occur with
up to k = budget * m edits. Then at least m - q + 1 - k * q of its q-grams occur unchanged on diagonals (place in the
document minus place in the item) that differ by at most 2k; k is never so large that fewer than four are left. Shared q-grams are counted in overlapping bands of
diagonals, two to each hit; bands that reach the bound are kept and verified by an alignment within the band.

Items under 32 bytes are phrases that a few edits turn into others: they are searched as they stand (k = 0), and only
where neither end cuts a word of ASCII letters and digits. Items under q = 8 bytes, a word or so, are not searched.

The benchmark is the stated query set: it is taken in blocks of bounded bytes, each broadcast and held against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces

Q, BUDGET = 8, 0.1
#: Items of fewer bytes are phrases rather than passages and are searched without edits, on word boundaries.
PHRASE = 32
#: Bytes of benchmark text in a broadcast block, bits of the first filter, and hits counted at once.
BLOCK_BYTES, FILTER_BITS, HITS = 4 << 20, 22, 4_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, item_id long, start long, end long, edits int"


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def q_grams(data: np.ndarray) -> np.ndarray:
    """The q bytes from each place on as one number."""
    out = np.empty(max(0, len(data) - Q + 1), np.uint64)
    for r in range(min(Q, len(out))):
        some = data[r : r + (len(data) - r) // Q * Q]
        out[r::Q] = np.ascontiguousarray(some).view(np.uint64)[: len(out[r::Q])]
    return out


@dataclass
class Index:
    """q-grams of a block of items, sorted, with the places of each."""

    ids: list[int]
    items: list[bytes]
    edits: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray


def build(rows: list[tuple[int, str]], budget: float = BUDGET) -> Index:
    rows = [(i, b) for i, t in rows if len(b := normal(t)) >= Q]
    sizes = np.array([len(b) for _, b in rows], np.int64)
    # never so many edits that the lemma would ask for fewer than four common q-grams
    edits = np.maximum(0, np.minimum((sizes * budget).astype(np.int64), (sizes - Q + 1 - 4) // Q))
    edits[sizes < PHRASE] = 0
    grams = [q_grams(np.frombuffer(b, np.uint8)) for _, b in rows]
    every = np.concatenate([np.zeros(0, np.uint64), *grams])
    item = np.repeat(np.arange(len(rows)), [len(g) for g in grams]) if rows else np.zeros(0, np.int64)
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
    order = np.argsort(every, kind="stable")
    values, first = np.unique(every[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(values * _SPREAD) >> np.uint64(64 - FILTER_BITS)] = True
    return Index([i for i, _ in rows], [b for _, b in rows], edits, sizes - Q + 1 - edits * Q, values, np.append(first, len(every)), item[order], place[order], seen)


def align(item: bytes, region: bytes, most: int) -> tuple[int, int] | None:
    """(edits, end in region) of the best occurrence of the item within the region, if it has at most ``most`` edits."""
    at = region.find(item)
    if at >= 0:
        return 0, at + len(item)
    text, n = np.frombuffer(region, np.uint8), len(region)
    steps = np.arange(n + 1)
    cost = np.zeros(n + 1, np.int64)
    for k, byte in enumerate(item):
        fresh = np.empty_like(cost)
        fresh[0] = k + 1
        fresh[1:] = np.minimum(cost[:-1] + (text != byte), cost[1:] + 1)
        cost = np.minimum.accumulate(fresh - steps) + steps
        if cost.min() > most:
            return None
    end = int(cost.argmin())
    return (int(cost[end]), end) if cost[end] <= most else None


def _cuts_word(data: np.ndarray, start: int, end: int) -> bool:
    """Does an ASCII letter or digit stand on both sides of the start or of the end?"""
    inside = [chr(b).isalnum() and b < 128 for b in (data[start - 1] if start else 0, data[start], data[end - 1], data[end])]
    return inside[0] and inside[1] or inside[2] and inside[3]


def search(index: Index, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits): the best occurrence of every item in every text that holds it."""
    if not index.items or not texts:
        return
    sizes = np.array([len(t) for t in texts], np.int64) + Q  # texts are kept apart by q zero bytes
    begin = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer((b"\0" * Q).join(texts) + b"\0" * Q, np.uint8)
    codes = q_grams(data)
    at = np.flatnonzero(index.seen[(codes * _SPREAD) >> np.uint64(64 - FILTER_BITS)])
    slot = np.minimum(np.searchsorted(index.grams, codes[at]), len(index.grams) - 1)
    hit = index.grams[slot] == codes[at]
    at, slot = at[hit], slot[hit]
    counts = index.first[slot + 1] - index.first[slot]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    cuts = np.searchsorted(np.cumsum(counts), np.arange(HITS, int(counts.sum()) + HITS, HITS), "left") + 1 if len(counts) else []
    a = 0
    kept: list[np.ndarray] = []
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for b in cuts:
        b = min(int(b), len(at))
        if b <= a:
            continue
        ends = np.cumsum(counts[a:b])
        where = np.repeat(index.first[slot[a:b]] - (ends - counts[a:b]), counts[a:b]) + np.arange(ends[-1])
        item, place = index.item[where], index.place[where]
        diagonal = np.repeat(at[a:b], counts[a:b]) - place + len(data)
        width = 2 * index.edits[item] + 1
        band = diagonal // width
        key = item.astype(np.int64) << 40 | band
        key, place = np.concatenate([key, key - 1]), np.concatenate([place, place])
        kept.append(np.stack(np.unique(key, return_counts=True)))
        pairs.append((key, place))
        a = b
    if not kept:
        return
    keys, sums = kept[0] if len(kept) == 1 else _added(kept)
    item = keys >> 40
    good = sums >= index.needed[item]
    keys, item = keys[good], item[good]
    if not len(keys):
        return
    # a q-gram that comes again in the band adds nothing: each place of the item counts once
    found = []
    for key, place in pairs:
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        own = keys[at] == key
        found.append(at[own] << 32 | place[own])
    good = np.bincount(np.unique(np.concatenate(found)) >> 32, minlength=len(keys)) >= index.needed[item]
    for key, i in zip(keys[good].tolist(), item[good].tolist(), strict=True):
        most, size = int(index.edits[i]), len(index.items[i])
        low = (key & (1 << 40) - 1) * (2 * most + 1) - len(data)
        start, stop = low - most, low + 2 * (2 * most + 1) + size + most
        middle = min(max((start + stop) // 2, 0), len(data) - 1)
        for text in {int(np.searchsorted(begin, min(max(p, 0), len(data) - 1), "right")) - 1 for p in (max(start, 0), middle, min(stop, len(data) - 1))}:
            lo, hi = max(start, begin[text]), min(stop, begin[text + 1] - Q)
            if hi - lo < size - most:
                continue
            found = align(index.items[i], data[lo:hi].tobytes(), most)
            if found and size < PHRASE and _cuts_word(data, lo + found[1] - size, lo + found[1]):
                continue  # another occurrence has a band of its own
            if found and ((text, i) not in best or found[0] < best[text, i][0]):
                end = int(lo - begin[text]) + found[1]
                best[text, i] = (found[0], max(0, end - size), end)
    for (text, i), (edits, start, end) in best.items():
        yield text, i, start, end, edits


def _added(kept: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, sums = (np.concatenate(x) for x in zip(*kept, strict=True))
    values, local = np.unique(keys, return_inverse=True)
    return values, np.bincount(local, sums).astype(np.int64)


def blocks(benchmark: DataFrame, budget: float = BUDGET) -> Iterator[Index]:
    """The benchmark's items in blocks of about BLOCK_BYTES; null texts and those under q bytes are left out."""
    rows = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").collect()
        yield build([(r.id, r.text) for r in own], budget)


def leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, item_id, start, end, edits: the best occurrence of every item in every document that holds it.

    Places are bytes of the normalised text; start is end less the item's length. Null and empty texts hold nothing;
    repeated rows are reported each, with a null id too; an empty table or benchmark gives an empty result. Rows of
    documents never move.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    out = None
    for index in blocks(benchmark, budget):
        some = source.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast(index)), SCHEMA)
        out = some if out is None else out.unionByName(some)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def _finder(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch, texts in pieces(batches, "text", 1 << 20):
            ids = batch.column(0).to_pylist()
            rows = [(ids[t], index.ids[i], s, e, c) for t, i, s, e, c in search(index, [normal(x) for x in texts.to_pylist()])]
            if rows:
                d, i, s, e, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(c, pa.int32())], ["doc_id", "item_id", "start", "end", "edits"])

    return work


def without_leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The input's columns and the rows that hold no item, block by block of the benchmark."""
    for index in blocks(benchmark, budget):
        docs = docs.mapInArrow(_keeper(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs


def _keeper(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            keep = np.ones(batch.num_rows, bool)
            for found in search(shared.value, [normal(x) for x in texts.to_pylist()]):
                keep[found[0]] = False
            yield batch.filter(pa.array(keep))

    return work
