"""Removal of long repeated byte strings by sharded suffix arrays.

Every string of ``length`` bytes holds an anchor: the k-gram with the least hash of all its k-grams, the leftmost of
equals. Equal strings hold equal anchors at the same place, so all that can be equal meets in the shard of its anchor.

1. Equal texts are one from here on (a text that occurs twice is removed as a whole, if long enough).
2. Anchors are counted by hash, with the least and greatest fingerprint of their surroundings (all strings of this
   length that hold the anchor). A hash seen once repeats nothing. Surroundings with equal fingerprints at different
   places repeat whole; that is an aggregate and a join, so a line or passage of any frequency needs no group of its rows.
3. Where surroundings of a hash differ, one of each fingerprint goes to the shard of the hash with its bytes. A shard builds a suffix array by prefix doubling
   in the manner of Larsson and Sadakane: groups of equal prefixes are numbered, and only groups of more than one are
   sorted again by the number ``h`` places on. Common prefixes come from the numbers of each doubling (Kasai's loop is
   sequential; this gives the same values up to ``length``). Strings in one group at different places are repeated.
4. A hash with very many surroundings is cut into several shards. Every two of them meet in one task, which has a suffix
   array of each and merges them by binary search over sorted string fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import bit_set, drop_written, flat_bytes, in_bit_set, pieces, sorted_groups, written
from .ngram_join import _BASE, _BASE_INVERSE, _power, mix

LENGTH, K = 200, 64
#: Surroundings of one hash in a shard, bytes that one suffix array takes, and the largest filter in bits (64 MB).
SHARD, ARRAY_BYTES, FILTER_BITS = 5000, 2 << 20, 29
#: Fingerprints that a task remembers having sent with bytes; sent again, they only cost space.
SEEN = 500_000
#: Copied texts up to which their keys (20 bytes each) are broadcast; above, Spark joins by shuffle.
BROADCAST_KEYS = 500_000
_BYTE = np.random.default_rng(9_071).integers(0, 2**64, 256, dtype=np.uint64)
_LOW = np.uint64(0xFFFFFFFF)


def _totals(data: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), dtype=np.uint64)])


def _range_hash(totals: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range, wherever it stands."""
    return mix((totals[end] - totals[start]) * _power("down", _BASE_INVERSE, max(len(totals) - 1, 1))[np.minimum(start, max(len(totals) - 2, 0))])


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Of all texts: hash, text, place, and first and last byte of the surroundings of each anchor, and their fingerprint."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    totals = _totals(data)
    n, width = len(data) - k + 1, length - k + 1
    at = np.arange(n)
    full = _range_hash(totals, at, at + k)
    least = full & ~_LOW | at.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    text = np.searchsorted(starts, np.arange(len(least)), "right") - 1
    inside = np.arange(len(least)) + length <= starts[text + 1]
    place = (least[inside] & _LOW).astype(np.int64)
    if not len(place):
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])]
    text = np.searchsorted(starts, place, "right") - 1
    first, last = np.maximum(starts[text], place - (length - k)), np.minimum(starts[text + 1], place + length)
    print_ = mix(_range_hash(totals, first, last) + ((place - first) * 65_537 + (last - place)).astype(np.uint64))
    return full[place], text, place, first, last, print_


def suffix_groups(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(group of each place, by order of its next ``length`` bytes; the suffix order itself). Past the end are zeros."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for r in range(8):
        key = key << np.uint64(8) | wide[r : r + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    rank = np.empty(n, np.int64)
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else np.zeros(0, bool)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while h < length:
        step = min(h, length - h)
        # groups of one are done; the others are sorted by the group ``step`` places on
        lone = head & np.concatenate([head[1:], [True]])
        open_ = np.flatnonzero(~lone)
        if not len(open_):
            break
        places = order[open_]
        after = np.where(places + step < n, rank[np.minimum(places + step, n - 1)], -1)
        again = np.lexsort((after, rank[places]))
        places, after, own = places[again], after[again], rank[places[again]]
        order[open_] = places
        head[open_] = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        fresh = np.maximum.accumulate(np.where(head[open_], open_, 0))
        rank = rank.copy()
        rank[places] = fresh
        h += step
    return rank, order


def _filter(known: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2^bits bits of the hashes. The low bits: anchors are minima, so their high bits are mostly zeros."""
    return bit_set(known.select(F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot")), bits)


def _in_filter(words: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    return in_bit_set(words, hashes & np.uint64((1 << bits) - 1))


def _counted(length: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            found = anchors(*flat_bytes(texts), length, k)
            yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[5].view(np.int64))], ["hash", "print"])

    return work


def _located(length: int, k: int, bits: int, shared):
    """Surroundings whose hash the filters know; the first of each fingerprint in a task with bytes, where they differ."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, mixed = shared.value
        seen: set[int] = set()
        for batch, texts in pieces(batches, "text"):
            data, starts = flat_bytes(texts)
            hashes, text, place, first, last, print_ = anchors(data, starts, length, k)
            keep = _in_filter(every, bits, hashes) & (last - first >= length)
            hashes, text, place, first, last, print_ = (x[keep] for x in (hashes, text, place, first, last, print_))
            if len(seen) > SEEN:
                seen.clear()
            raw, content = memoryview(data), []
            for a, b, p, differs in zip(first.tolist(), last.tolist(), print_.tolist(), _in_filter(mixed, bits, hashes).tolist(), strict=True):
                fresh = differs and p not in seen
                content.append(bytes(raw[a:b]) if fresh else None)
                if fresh:
                    seen.add(p)
            key = batch.column(0).to_numpy()[text]
            columns = [pa.array(hashes.view(np.int64)), pa.array(key), pa.array(first - starts[text]), pa.array(last - starts[text]), pa.array(print_.view(np.int64)), pa.array(content, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "key", "first", "last", "print", "content"])

    return work


def _repeated(content: list[bytes], owner: np.ndarray, first: np.ndarray, part: np.ndarray, whole: np.ndarray, length: int) -> np.ndarray:
    """Of every place of the concatenated contents: does its string also begin at another place of a text?

    Strings of surroundings that repeat ``whole`` do.
    """
    data = np.frombuffer(b"".join(content), np.uint8)
    sizes = np.array([len(c) for c in content], np.int64)
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(data)) - begin[row]
    valid = inner + length <= sizes[row]
    # one number for each place of a text: the same place may be in the surroundings of several anchors
    spot = (owner[row] << 32 | first[row] + inner)[valid]
    out = np.zeros(len(data), bool)
    at = np.flatnonzero(valid)
    side = part[row[at]]
    if side.min() == side.max():
        rank = suffix_groups(data, length)[0][at]
    else:  # a suffix array of each shard, merged by binary search
        rank = np.empty(len(at), np.int64)
        low, high = side == side.min(), side == side.max()
        a, b = (suffix_groups(data[np.isin(row, np.flatnonzero(part == s))], length)[0] for s in (side.min(), side.max()))
        own = part[row]
        for mask, s, groups in ((low, side.min(), a), (high, side.max(), b)):
            local = np.cumsum(own == s) - 1
            rank[mask] = groups[local[at[mask]]] + (0 if s == side.min() else len(data))
        totals = _totals(data)
        prints = _range_hash(totals, at, at + length)
        order = np.argsort(prints[low], kind="stable")
        ordered = prints[low][order]
        found = np.minimum(np.searchsorted(ordered, prints[high]), len(ordered) - 1)
        same = ordered[found] == prints[high]
        rank[np.flatnonzero(high)[same]] = rank[low][order[found[same]]]
    groups = rank
    least, most = np.full(groups.max() + 1, np.iinfo(np.int64).max), np.full(groups.max() + 1, -1)
    np.minimum.at(least, groups, spot)
    np.maximum.at(most, groups, spot)
    several = least < most
    np.logical_or.at(several, groups, whole[row[at]])
    out[at] = several[groups]
    return out


def _sharded(length: int):
    def intervals(rows: pa.Table) -> pa.RecordBatch:
        hashes, key, first, last, print_, part = (rows.column(c).to_numpy() for c in ("hash", "key", "first", "last", "print", "part"))
        content = rows.column("content").to_pylist()
        whole_row = rows.column("whole").to_numpy(zero_copy_only=False).astype(bool)
        same = np.unique(np.stack([hashes, print_], 1), axis=0, return_inverse=True)[1].ravel()
        one = np.unique(same, return_index=True)[1]
        owners = np.unique(key, return_inverse=True)[1].ravel()
        flags = _repeated([content[i] for i in one], owners[one], first[one], part[one], whole_row[one], length)
        sizes = np.array([len(content[i]) for i in one], np.int64)
        begin = np.cumsum(sizes) - sizes
        edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
        ups, downs = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        # a run of flags never leaves its surroundings: their last places are no beginnings
        group = np.searchsorted(begin, ups, "right") - 1
        out_key, out_first, out_last = [key[:0]], [first[:0]], [last[:0]]
        for i in one[~whole_row[one]]:
            a, b = np.searchsorted(group, [same[i], same[i] + 1])
            for u, d in zip(ups[a:b], downs[a:b], strict=True):
                out_key.append(key[i : i + 1])
                out_first.append(np.array([first[i] + u - begin[same[i]]]))
                out_last.append(np.array([first[i] + d - begin[same[i]] - 1 + length]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_key, out_first, out_last)], ["key", "first", "last"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in sorted_groups(batches, ["hash", "i", "j"]):
            own = group.column("content").nbytes
            many = group.column("parts")[0].as_py() > 1
            if held and (many or size + own > ARRAY_BYTES):
                yield intervals(pa.concat_tables(held))
                held, size = [], 0
            held.append(group)
            size += own
            if many:
                yield intervals(group)
                held, size = [], 0
        if held:
            yield intervals(pa.concat_tables(held))

    return work


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(first, kind="stable")
    out: list[list[int]] = []
    for a, b in zip(first[order].tolist(), last[order].tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _removed(length: int, with_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            data, starts = flat_bytes(texts)
            raw = memoryview(np.ascontiguousarray(data))
            copies = batch.column("copies").to_numpy(zero_copy_only=False)
            firsts, lasts = batch.column("firsts").to_pylist(), batch.column("lasts").to_pylist()
            n_bytes, removed, spans, hashes, kept_texts = [], [], [], [], []
            for i in range(batch.num_rows):
                a, b = int(starts[i]), int(starts[i + 1])
                if copies[i] > 1 and b - a >= length:
                    runs = [(0, b - a)]
                else:
                    runs = _merged(np.array(firsts[i] or [], np.int64), np.array(lasts[i] or [], np.int64))
                kept, at = [], 0
                for s, e in runs:
                    kept.append(raw[a + at : a + s])
                    at = e
                kept.append(raw[a + at : b])
                text = b"".join(kept)
                n_bytes.append(b - a)
                removed.append(sum(e - s for s, e in runs))
                spans.append(len(runs))
                hashes.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept_texts.append(text)
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept_texts, pa.binary())] * with_text, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return work


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; on demand also the bytes ``kept``.

    Null and empty texts have nothing to remove, nor have texts shorter than ``length``. Rows with equal texts, equal
    ids or null ids are documents each. An empty table gives an empty table; other columns are not read.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    # a text is known by 64 bits of its bytes
    keyed = source.withColumn("key", F.xxhash64(F.col("text"), F.octet_length("text")))
    long_ = keyed.where(F.octet_length("text") >= length)
    copies = written(long_.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("keeper")).where("copies > 1"))
    few = lambda df, most: F.broadcast(df) if df.limit(most + 1).count() <= most else df
    single = long_.join(few(copies, BROADCAST_KEYS), "key", "left").where("copies is null or doc_id <=> keeper").select("key", "text")

    counted = single.select("text").mapInArrow(_counted(length, k), "hash long, print long")
    known = counted.groupBy("hash").agg(F.count("*").alias("n"), F.min("print").alias("p1"), F.max("print").alias("p2")).where("n > 1")
    known = written(known.select("hash", "n", (F.col("p1") != F.col("p2")).alias("mixed")))
    bits = int(min(FILTER_BITS, max(16, np.ceil(np.log2(16 * max(known.count(), 1))))))
    shared = docs.sparkSession.sparkContext.broadcast((_filter(known, bits), _filter(known.where("mixed"), bits)))
    located = written(single.mapInArrow(_located(length, k, bits, shared), "hash long, key long, first long, last long, print long, content binary"))
    classes = located.groupBy("hash", "print").agg(F.min("key").alias("k1"), F.max("key").alias("k2"), F.min("first").alias("f1"), F.max("first").alias("f2"))
    classes = written(classes.where("k1 <> k2 or f1 <> f2").select("hash", "print", F.lit(True).alias("whole")))
    even = located.select("hash", "print", "key", "first", "last").join(classes, ["hash", "print"]).select("key", "first", "last")

    differing = located.where("content is not null").join(known.where("mixed").select("hash"), "hash", "left_semi")
    parts = written(differing.groupBy("hash").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts")))
    differing = differing.join(parts, "hash").join(classes, ["hash", "print"], "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    differing = differing.withColumn("part", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = differing.select("hash", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "parts", "part", "key", "first", "last", "print", "whole", "content")
    dealt = dealt.repartition("hash", "i", "j").sortWithinPartitions("hash", "i", "j")
    odd = dealt.mapInArrow(_sharded(length), "key long, first long, last long")

    # of all intervals from one place only the longest counts, and of those that overlap only the ends of their union
    longest = even.unionByName(odd).groupBy("key", "first").agg(F.max("last").alias("last"))
    order = Window.partitionBy("key").orderBy("first")
    opened = longest.withColumn("upto", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    opened = opened.withColumn("run", F.sum(F.when(F.col("first") <= F.col("upto"), 0).otherwise(1)).over(order))
    unions = opened.groupBy("key", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    spans = written(unions.groupBy("key").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")))
    drop_written(located)
    rows = keyed.join(few(copies.select("key", "copies"), BROADCAST_KEYS), "key", "left").join(spans, "key", "left")
    rows = rows.select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "firsts", "lasts")
    return rows.mapInArrow(_removed(length, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
