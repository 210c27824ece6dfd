"""Jaccard self-join of documents on word shingles, by a blocked sparse product of document and shingle incidence.

1. Every text becomes the set of hashes of its shingles; documents with equal sets are one class from here on.
2. Classes that share a minimum under one of a few hash orders are compared with the smallest class of that minimum
   (stars, so a group of any size costs as many comparisons as members). What is linked forms first components.
3. Completeness: for similarity t a class of n shingles lets its last ceil(t * n) - l of a global order go; any partner
   shares at least l of the rest. Shingles that many documents hold come last in that order, so they are rarely kept.
   A task has a block of shingle columns of the incidence matrix and adds up the product with its transpose, for pairs
   of different components and fitting sizes only. Sums over all blocks below l drop out, the others are verified.
   Columns that very many documents keep are multiplied differently: their documents are cut into blocks, and a task
   has the whole rows of two blocks, adds up the exact overlaps and returns the links that join components. What such
   columns could add to a pair's sum is granted to it before it may drop out.

All comparisons are exact on 64-bit shingle hashes; steps 2 and the order of step 3 only save work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import drop_written, flat_bytes, pieces, sorted_groups, written
from .components import components

ORDERS = 4
#: Shared shingles asked of kept shingles, in step 3.
SHARED = 4
#: A shingle counts as frequent from so many documents of one run of texts on; at most so many are remembered. Only the
#: order of shingles depends on it.
RUN_COUNT, FREQUENT = 3, 500_000
#: Documents that keep a shingle from which its column goes by blocks, and documents of a block.
CROWD, BLOCK = 64, 500
#: Members that one task compares with a star's middle, before the star is split.
STAR_ROWS = 2000
#: Ids up to which a table of ids is broadcast (16 bytes each); above, Spark joins by shuffle.
BROADCAST_IDS = 1_000_000
_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * 2 + 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_ORDER = _RNG.integers(0, 2**63, ORDERS, dtype=np.uint64) * 2 + 1
#: Powers that a worker keeps (8 bytes each); those of a longer text are made for it alone.
POWERS = 1 << 21
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) >= n:
        return _powers[name][:n]
    steps = np.full(max(n, 1 << 16), base, np.uint64)
    steps[0] = 1
    steps = np.multiply.accumulate(steps)
    if n <= POWERS:
        _powers[name] = steps
    return steps[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word (runs of bytes that are no white space, A-Z lower-cased), and its text's number."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), dtype=np.uint64)])
    found = mix((total[end] - total[begin]) * _power("down", _BASE_INVERSE, len(data))[begin])
    return found, np.searchsorted(starts, begin, "right") - 1


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words has none."""
    data, starts = flat_bytes(texts)
    found, text = word_hashes(data, starts)
    counts = np.bincount(text, minlength=len(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    full = np.zeros(max(0, len(found) - words + 1), np.uint64)
    for k in range(words):
        full += found[k : k + len(full)] * _PLACE[k]
    full = mix(full)
    for i, n in enumerate(counts):
        if n >= words:
            yield np.unique(full[at[i] : at[i + 1] - words + 1])
        elif n:
            yield mix((found[at[i] : at[i + 1]] * _PLACE[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)


def signature(tokens: np.ndarray) -> int:
    """64 bits that name a set."""
    return int(mix(mix(tokens).sum(keepdims=True) + np.uint64(len(tokens)))[0].view(np.int64)) if len(tokens) else 0


def _profiles(words: int):
    """Rows of kind 0: a document's size, set signature and minima; of kind 1: a frequent shingle and its count."""

    def rows(ids, sets):
        out = {"kind": [], "id": [], "n": [], "s1": [], "minima": []}
        for i, s in zip(ids, sets, strict=True):
            out["kind"].append(0)
            out["id"].append(i)
            out["n"].append(len(s))
            out["s1"].append(signature(s))
            out["minima"].append([int((s * m).min().view(np.int64)) for m in _ORDER] if len(s) else [])
        return out

    schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("minima", pa.list_(pa.int64()))])

    def frequent(kept: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(kept), return_counts=True)
        often = counts >= RUN_COUNT
        values, counts = values[often].view(np.int64), counts[often]
        return pa.RecordBatch.from_pydict({"kind": np.ones(len(values), np.int32), "id": [None] * len(values), "n": counts, "s1": values, "minima": [None] * len(values)}, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch, texts in pieces(batches, "text"):
            sets = list(shingle_sets(texts, words))
            yield pa.RecordBatch.from_pydict(rows(batch.column(0).to_pylist(), sets), schema)
            kept += sets
            size += sum(map(len, sets))
            if size > 2_000_000:
                yield frequent(kept)
                kept, size = [], 0
        if kept:
            yield frequent(kept)

    return work


def _sets(words: int):
    """The sets of texts; a text whose id stands on other rows too is passed over unless its set is the node's."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            nodes = batch.column(0).to_pylist()
            own = [(node, s) for node, s in zip(nodes, shingle_sets(texts, words), strict=True) if signature(s) == node]
            flat = np.concatenate([np.zeros(0, np.uint64), *(s for _, s in own)]).view(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(s) for _, s in own])])
            yield pa.RecordBatch.from_arrays([pa.array([node for node, _ in own], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["node", "tokens"])

    return work


def _kept_shingles(words: int, num: int, den: int, frequent):
    """Of each document the first shingles of the global order, as many as completeness asks for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, level = frequent.value
        for batch, texts in pieces(batches, "text"):
            ids, comps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tokens, owner, sizes, least, lead = [], [], [], [], []
            for i, s in enumerate(shingle_sets(texts, words)):
                n = len(s)
                if not n or signature(s) != ids[i]:
                    continue
                need = -(-num * n // den)
                shared = min(SHARED, need)
                take = n - need + shared
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    s = s[np.argsort(np.where(often[at] == s, level[at], 0), kind="stable")]
                tokens.append(s[:take])
                lead.append(np.arange(min(take, n)) <= n - need)
                owner.append(np.full(min(take, n), i))
                sizes.append(np.full(min(take, n), n))
                least.append(np.full(min(take, n), shared, np.int32))
            if tokens:
                owner = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(ids[owner]), pa.array(comps[owner]), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(least)), pa.array(np.concatenate(lead))], ["token", "node", "component", "n", "shared", "lead"])

    return work


def _product(num: int, den: int):
    """Add up the product of a block of shingle columns, for pairs of different components and fitting sizes."""

    def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
        token, ids, comp, n, least = columns
        order = np.lexsort((n, token))
        token, ids, comp, n, least = token[order], ids[order], comp[order], n[order], least[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        last = np.repeat(np.append(first[1:], len(token)), np.diff(np.append(first, len(token))))
        found: list[np.ndarray] = []
        step = 1
        at = np.arange(len(token))
        while True:
            at = at[at + step < last[at]]
            if not len(at):
                break
            at = at[n[at] * den >= num * n[at + step]]  # sizes ascend: no later partner fits either
            ok = at[comp[at] != comp[at + step]]
            a, b = ids[ok], ids[ok + step]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b), np.minimum(least[ok], least[ok + step]).astype(np.int64)]))
            step += 1
        every = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        distinct, counts = np.unique(every, axis=1, return_counts=True) if every.shape[1] else (every, np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([*map(pa.array, distinct), pa.array(counts)], ["a", "b", "shared", "count"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size, last = 0, None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(columns[0]):
                continue
            # whole columns of the matrix only: what has the last token waits for the next batch
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if size > 500_000 and (cut or columns[0][0] != last):
                held.append([c[:cut] for c in columns])
                yield pairs([np.concatenate(c) for c in zip(*held, strict=True)])
                held, size = [], 0
                columns = [c[cut:] for c in columns]
            held.append(columns)
            last = columns[0][-1]
            size += len(columns[0])
        if held:
            yield pairs([np.concatenate(c) for c in zip(*held, strict=True)])

    return work


def _blocks(num: int, den: int):
    """Exact overlaps of the documents of two blocks; of the similar pairs those that join components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["token", "i", "j"]):
            comp, node, side = (group.column(c).to_numpy() for c in ("component", "node", "side"))
            if comp.min() == comp.max():
                continue
            lists = group.column("tokens").combine_chunks()
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            sizes = np.diff(offsets)
            values, local, counts = np.unique(flat, return_inverse=True, return_counts=True)
            column = np.cumsum(counts > 1) - 1  # a shingle of one document adds nothing
            keep = counts[local] > 1
            row, local = np.repeat(np.arange(len(node)), sizes)[keep], column[local[keep]]
            both = np.zeros((len(node), len(node)), np.float32)
            order = np.argsort(local, kind="stable")
            row, local = row[order], local[order]
            for at in range(0, int(local[-1]) + 1 if len(local) else 0, 4096):
                a, b = np.searchsorted(local, [at, at + 4096])
                part = np.zeros((len(node), 4096), np.float32)
                part[row[a:b], local[a:b] - at] = 1
                both += part @ part.T
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            near = den * both >= num * (sizes[:, None] + sizes[None, :] - both)
            if i != j:
                near &= side[:, None] != side[None, :]
            root = np.unique(comp, return_inverse=True)[1]
            a, b = [], []
            for r in range(len(node)):
                other = np.flatnonzero(near[r] & (root != root[r]))
                for k in other[np.unique(root[other], return_index=True)[1]]:
                    a.append(node[r])
                    b.append(node[k])
                    root[root == root[k]] = root[r]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work


def _verify(num: int, den: int):
    """Compare each member's set with that of its star's middle, which comes first in the partition's order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, tokens = None, np.zeros(0, np.int64)
        for batch in batches:
            star, member = batch.column("star").to_pylist(), batch.column("member").to_pylist()
            lists = batch.column("tokens")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            a, b = [], []
            for i, (s, m) in enumerate(zip(star, member, strict=True)):
                own = flat[offsets[i] : offsets[i + 1]]
                if s == m:
                    middle, tokens = s, own.copy()
                elif s == middle and len(own):
                    both = _overlap(tokens, own)
                    if den * both >= num * (len(tokens) + len(own) - both):
                        a.append(s)
                        b.append(m)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a.view(np.uint64), b.view(np.uint64))
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def _small(rows: DataFrame) -> DataFrame:
    """Broadcast a narrow table of ids when it has few rows, by count; else leave the join to Spark."""
    return F.broadcast(rows) if rows.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else rows


def _sets_of(nodes: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    needed = written(classes.select("id", "node").join(nodes.distinct(), "node"))
    return texts.join(_small(needed), "id").select("node", "text").mapInArrow(_sets(words), "node long, tokens array<long>")


def _links(edges: DataFrame, classes: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Of candidate (star, member) pairs those that are similar enough, as (a, b); written."""
    edges = written(edges.distinct())
    stars = edges.groupBy("star").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("parts"))
    stars = written(stars)
    every = edges.select("star", "member", F.lit(False).alias("middle")).join(stars, "star")
    spread = every.withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    middles = stars.select("star", F.col("star").alias("member"), F.lit(True).alias("middle"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = written(spread.select("star", "member", "middle", "part").unionByName(middles.select("star", "member", "middle", "part")))
    sets = _sets_of(wanted.select(F.col("member").alias("node")), classes, texts, words)
    rows = sets.join(_small(wanted), sets.node == F.col("member")).select("star", "part", "member", "middle", "tokens")
    dealt = rows.repartition("star", "part").sortWithinPartitions("star", "part", F.desc("middle"))
    links = written(dealt.select("star", "member", "tokens").mapInArrow(_verify(num, den), "a long, b long"))
    for x in (edges, stars, wanted):
        drop_written(x)
    return links


def _block_links(crowded: DataFrame, classes: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links within the columns that many documents keep. A linked pair leads with at least one common shingle."""
    rows = crowded.where("lead").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = written(rows.select("token", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "component"))
    sets = _sets_of(rows.select("node"), classes, texts, words)
    dealt = sets.join(_small(rows), "node").select("token", "i", "j", "side", "node", "component", "tokens").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(_blocks(num, den), "a long, b long")


def ngram_jaccard(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, id_column: str = "doc_id", text_column: str = "text", nodes: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, with ``nodes`` also the set's signature and its component: linked where den * |intersection| >= num * |union|.

    Texts that are null, empty or without words have no shingles and link with nothing (component_id is the row's own
    id). A null id has a null component and joins none. Repeated ids are separate rows of equal ids; other columns are
    not read; an empty table gives an empty table.
    """
    source = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"))
    profile = written(source.mapInArrow(_profiles(words), "kind int, id long, n long, s1 long, minima array<long>"))
    rows = profile.where("kind = 0").select("id", "n", F.col("s1").alias("node"), "minima")
    known = rows.where("n > 0 and id is not null")
    # one class for each set; its signature is the node of the links, and its smallest id names it
    classes = written(known.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("minima").alias("minima")))
    often = profile.where("kind = 1").groupBy("s1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s1").limit(FREQUENT).collect()
    often = np.array(sorted((r.s1 % 2**64, r.n) for r in often), np.uint64).reshape(-1, 2)
    frequent = docs.sparkSession.sparkContext.broadcast((often[:, 0].copy(), np.ceil(np.log2(np.maximum(often[:, 1], 2))).astype(np.int8)))
    texts = source.where("id is not null")

    minima = classes.select("node", F.posexplode("minima").alias("k", "m"))
    stars = minima.groupBy("k", "m").agg(F.min("node").alias("star"), F.count("*").alias("members")).where("members > 1").select("k", "m", "star")
    edges = minima.join(stars, ["k", "m"]).where("node <> star").select("star", F.col("node").alias("member"))
    first = _links(edges, classes, texts, words, num, den)
    parts = classes.select("id", "node").join(components(first), "node", "left").select("id", "node", F.coalesce("component", "node").alias("component"))
    parts = written(parts)

    kept = texts.join(_small(parts), "id").select("node", "component", "text").mapInArrow(_kept_shingles(words, num, den, frequent), "token long, node long, component long, n long, shared int, lead boolean")
    kept = written(kept)
    crowd = kept.groupBy("token").agg(F.count("*").alias("members"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    crowd = written(crowd.where(F.col("members") > CROWD).select("token", "members", (F.col("c1") != F.col("c2")).alias("mixed")))

    dealt = kept.join(_small(crowd.select("token")), "token", "left_anti").select("token", "node", "component", "n", "shared").repartition("token").sortWithinPartitions("token")
    summed = dealt.mapInArrow(_product(num, den), "a long, b long, shared long, count long").groupBy("a", "b").agg(F.min("shared").alias("shared"), F.sum("count").alias("count"))
    crowded = written(kept.join(_small(crowd.where("mixed").select("token", "members")), "token"))
    granted = crowded.groupBy("node").agg(F.count("*").alias("granted"))
    for end in ("a", "b"):
        summed = summed.join(_small(granted).select(F.col("node").alias(end), F.col("granted").alias(f"granted_{end}")), end, "left")
    enough = F.col("count") + F.least(F.coalesce("granted_a", F.lit(0)), F.coalesce("granted_b", F.lit(0))) >= F.col("shared")
    second = _links(summed.where(enough).select(F.col("a").alias("star"), F.col("b").alias("member")), classes, texts, words, num, den)
    third = written(_block_links(crowded, classes, texts, words, num, den))

    linked = classes.select("id", "node").join(components(first.unionByName(second).unionByName(third)), "node", "left").select("id", "node", F.coalesce("component", "node").alias("component"))
    linked = written(linked)
    named = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    out = rows.select("id", "n", "node").join(linked.join(named, "component").select("node", "component", "component_id"), "node", "left")
    own = F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"), *(["node", "component"] if nodes else []))


def with_signatures(docs: DataFrame, words: int, output: str) -> DataFrame:
    """The input's columns and the signature of each text's set; 0 for texts without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            own = pa.array([signature(s) for s in shingle_sets(texts, words)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, output])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(output, LongType())]))
