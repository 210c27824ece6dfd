"""Spelling variants by blocked Gram matrices of letter counts.

1. Runs of letters are counted in SQL functions; a variant of a run loses one letter by a checksum of document and run.
2. One inserted, deleted or replaced letter moves the vector of letter counts by a squared distance of one (lengths one
   apart) or two (equal lengths). Words are dealt into blocks by length and by how many letters of two groups they have:
   near words lie in the same block or in one of twelve neighbours, so no two other blocks ever meet.
3. A task has a tile of a block and a chunk of the block and its six followers; the products of their count matrices give
   all squared distances. Pairs at most two apart are verified letter by letter. Tiles and chunks have a bounded number
   of letters, whatever the size of a block.
4. Each tile gives one row for each word that has neighbours (how many, and the most frequent), not the pairs.
5. Forms are followed to the last by pointer jumping: counts grow tenfold a step, so five rounds reach any end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import drop_written, sorted_groups, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters: a-z and U+00C0 to U+00FF; the group of a letter is its code point modulo 4.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
GROUPS = ["".join(c for c in LETTERS if ord(c) % 4 == g) for g in range(4)]
#: From a block to itself and the neighbours that follow it: change of length and of the letters of the first two groups.
STEPS = [(0, 0, 0), (0, 1, -1), (0, 1, 0), (0, 0, 1), (1, 1, 0), (1, 0, 1), (1, 0, 0)]
#: Words of a tile at most, its letters at most, and letters of candidate pairs verified at once.
TILE_WORDS, TILE_LETTERS, VERIFY_LETTERS = 2048, 1 << 20, 1 << 21
BLOCK = ["length", "g0", "g1"]
KEYS = [*BLOCK, "i", "j"]
#: Mark of the words of a block as rows of its products; as columns they carry the number of the step.
OWN = -1


def word_counts(docs: DataFrame, least_length: int, least_count: int, every: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, n: runs of letters, one letter less where ``every`` divides the checksum of ``<id>:<run>``."""
    text = F.translate(docs[text_column].cast("string"), UPPER, LOWER)
    runs = docs.select(docs[id_column].cast("string").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, less).otherwise(F.col("run"))
    words = runs.select("run", h.alias("h")).select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each word has each letter. Distances must be exact: from 2,048 letters on, in double precision."""
    rows, length = letters.shape
    index = np.where(letters < 0xC0, letters - 97, letters.astype(np.int64) - 0xC0 + 26)
    flat = (np.arange(rows)[:, None] * len(LETTERS) + index).ravel()
    return np.bincount(flat, minlength=rows * len(LETTERS)).reshape(rows, -1).astype(np.float32 if length < 2048 else np.float64)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of words whose lengths are equal or b's one more: exactly one letter replaced, or inserted into a."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    before = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= n


def near_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the words one edit apart; the words on the right are as long as those on the left, or one letter longer."""
    none = np.zeros(0, np.int64)
    x, y = _letter_counts(left), _letter_counts(right)
    # sorted by the letters of one more group, which differ by at most one as well
    inner = [sum(counts[:, LETTERS.index(c)] for c in GROUPS[2]) for counts in (x, y)]
    of_a, of_b = (np.argsort(k, kind="stable") for k in inner)
    x, y, inner = x[of_a], y[of_b], [inner[0][of_a], inner[1][of_b]]
    both = x.any(axis=0) & y.any(axis=0)
    ones = [np.ones((len(m), 1), x.dtype) for m in (x, y)]
    # rows extended so that their product is the squared distance
    x = np.concatenate([x[:, both], (x * x).sum(axis=1, keepdims=True), ones[0]], axis=1)
    y = np.concatenate([-2 * y[:, both], ones[1], (y * y).sum(axis=1, keepdims=True)], axis=1).astype(x.dtype)
    found_a, found_b = [none], [none]
    at_once = max(1, VERIFY_LETTERS // left.shape[1])
    values, starts = np.unique(inner[0], return_index=True)
    for value, start, end in zip(values, starts, np.append(starts[1:], len(x)), strict=True):
        low, high = np.searchsorted(inner[1], [value - 1, value + 2])
        for strip in range(start, end if high > low else start, 256):
            apart = x[strip : min(strip + 256, end)] @ y[low:high].T
            close = np.flatnonzero(apart <= 2)
            close = close[apart.ravel()[close] > 0]  # anagrams are at distance zero and never one edit apart
            i, j = of_a[strip + close // (high - low)], of_b[low + close % (high - low)]
            for k in range(0, len(i), at_once):
                p, q = i[k : k + at_once], j[k : k + at_once]
                ok = _one_edit(left[p], right[q])
                found_a.append(p[ok])
                found_b.append(q[ok])
    return np.concatenate(found_a), np.concatenate(found_b)


def _best(a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray) -> pa.RecordBatch:
    """For each word of the links (a, b): its links, and the other end of largest count (ties: the smallest word)."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)  # in code-point order
    other, other_n = np.concatenate([at[len(a) :], at[: len(a)]]), np.concatenate([b_n, a_n])
    sort = np.lexsort((other, -other_n, at))
    word, other, other_n = at[sort], other[sort], other_n[sort]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    text = [name.decode("latin-1") for name in names.tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([text[i] for i in word[first]], pa.string()), pa.array(np.diff(np.append(first, len(word))), pa.int64()),
         pa.array([text[i] for i in other[first]], pa.string()), pa.array(other_n[first], pa.int64())],
        ["word", "links", "near", "near_n"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a tile, a byte for each letter, and their counts, as one row."""
    for group in sorted_groups(batches, [*BLOCK, "tile"]):
        words, counts = "".join(group.column("word").to_pylist()).encode("latin-1"), group.column("n").to_numpy().astype("<i8").tobytes()
        keys = [group.column(c)[:1].combine_chunks() for c in (*BLOCK, "tile")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array([words], pa.binary()), pa.array([counts], pa.binary())], [*BLOCK, "tile", "words", "counts"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in sorted_groups(batches, KEYS):
        length, steps = group.column("length")[0].as_py(), group.column("step").to_numpy()
        words, counts = ([v.as_buffer() for v in group.column(c)] for c in ("words", "counts"))
        if OWN not in steps:  # a tile that got no word
            continue
        own = int(np.flatnonzero(steps == OWN)[0])
        left, left_n = np.frombuffer(words[own], np.uint8).reshape(-1, length), np.frombuffer(counts[own], "<i8")
        found: list[tuple[np.ndarray, ...]] = []
        for k, step in enumerate(steps):
            if step == OWN:
                continue
            wide = length + STEPS[step][0]
            right, right_n = np.frombuffer(words[k], np.uint8).reshape(-1, wide), np.frombuffer(counts[k], "<i8")
            i, j = near_pairs(left, right)
            a, b = (np.ascontiguousarray(m[at]).view(f"S{m.shape[1]}").ravel() for m, at in ((left, i), (right, j)))
            once = a < b if step == 0 else np.ones(len(a), bool)  # within a block each pair comes twice
            found.append((a[once], b[once], left_n[i[once]], right_n[j[once]]))
        if any(len(links[0]) for links in found):
            a, b, a_n, b_n = (np.concatenate(x) for x in zip(*found, strict=True))
            yield _best(a, b, a_n, b_n)


def _neighbours(words: DataFrame) -> DataFrame:
    """word, links, near, near_n: a row for each tile in which the word has neighbours; written."""
    count = lambda letters: F.length("word") - F.length(F.translate("word", letters, ""))
    placed = written(words.select("word", "n", F.length("word").alias("length"), count(GROUPS[0]).alias("g0"), count(GROUPS[1]).alias("g1")))
    blocks = written(placed.groupBy(*BLOCK).agg(F.count("*").alias("words")))
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), *[F.lit(d).alias(c) for d, c in zip(s, ("dl", "d0", "d1"))]) for k, s in enumerate(STEPS)])).alias("s")
    moved = blocks.select(*BLOCK, F.col("words").alias("own"), steps).select(*BLOCK, "own", "s.step", *[(F.col(c) + F.col(f"s.{d}")).alias(f"to_{c}") for c, d in zip(BLOCK, ("dl", "d0", "d1"))])
    met = written(moved.join(blocks.select(*[F.col(c).alias(f"to_{c}") for c in BLOCK], "words"), [f"to_{c}" for c in BLOCK]))
    rows = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_LETTERS) / F.col("length"))))
    sizes = met.groupBy(*BLOCK).agg(F.max("own").alias("own"), F.sum("words").alias("words"))
    sizes = written(sizes.select(*BLOCK, F.ceil(F.col("own") / rows).cast("int").alias("tiles"), F.ceil(F.col("words") / (4 * rows)).cast("int").alias("chunks")))
    # a row for each tile, so what is sent to several tasks is letters and little else
    dealt = placed.join(sizes.select(*BLOCK, "tiles"), BLOCK).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    dealt = dealt.select(*BLOCK, "tile", "word", "n").repartition(*BLOCK, "tile").sortWithinPartitions(*BLOCK, "tile", "word")
    packed = written(dealt.mapInArrow(_packed, "length int, g0 int, g1 int, tile int, words binary, counts binary"))
    # where a tile goes: as rows of its own products, and as columns of those of its neighbours
    goal = F.struct(*BLOCK, "step", "tiles", "chunks").alias("goal")
    roles = sizes.withColumn("step", F.lit(OWN)).select(*BLOCK, goal)
    roles = written(roles.unionByName(met.join(sizes, BLOCK).select(*[F.col(f"to_{c}").alias(c) for c in BLOCK], goal)))
    sent = packed.join(roles, BLOCK).select("goal.*", "words", "counts", F.when(F.col("goal.step") == OWN, F.col("tile")).otherwise(F.pmod(F.hash(*BLOCK, "tile"), F.col("goal.chunks"))).alias("at"))
    mine = F.col("step") == OWN
    sent = sent.withColumn("with", F.explode(F.sequence(F.lit(0), F.when(mine, F.col("chunks")).otherwise(F.col("tiles")) - 1)))
    sent = sent.select(*BLOCK, F.when(mine, F.col("at")).otherwise(F.col("with")).alias("i"), F.when(mine, F.col("with")).otherwise(F.col("at")).alias("j"), "step", "words", "counts")
    # a chunk may have got no tile, and then nothing to compare its rows with
    near = written(sent.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(_tiles, "word string, links long, near string, near_n long"))
    for made in (placed, blocks, met, sizes, packed, roles):
        drop_written(made)
    return near


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of every word that has a form. Each round doubles the steps that a row has followed."""
    ends = written(forms.select("word", F.col("form").alias("root")))
    while True:
        jumps = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(ends.join(jumps, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not after.where("moved").isEmpty()
        drop_written(ends)
        ends = after.select("word", "root")
        if not moved:
            return ends


def spelling_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, every: int = 31, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``least_length`` letters that occurs ``least_count`` times.

    Null, empty and letterless texts hold no words; a null id counts as the empty text before the colon. Repeated rows
    count each. Of neighbours with equal counts the smallest word is the form. An empty table gives an empty table;
    other columns are not read, whatever their names.
    """
    if least_length < 2:
        raise ValueError("least_length must be at least 2")
    words = written(word_counts(docs, least_length, least_count, every, id_column, text_column))
    near = _neighbours(words).groupBy("word").agg(F.sum("links").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    formed: Column = -F.col("best.n") >= ratio * F.col("n")
    known = written(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")))
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants_sql(least_length: int = 7, least_count: int = 2, ratio: int = 10, every: int = 31) -> str:
    """The same over ``documents`` as DuckDB SQL: near words share what is left when one letter goes, or are it."""
    return f"""
with recursive crc_table as (
    select list(list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as t
    from (select unnest(range(256)) as b)),
runs as (select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) as run from documents),
distinct_runs as (select id, run, count(*) as n from runs where length(run) >= {least_length} group by all),
hashed as (select run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
        lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] end))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
    from distinct_runs, crc_table),
words as materialized (select w as word, cast(sum(n) as bigint) as n from (
    select case when h % {every} = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as w, n from hashed)
    where length(w) >= {least_length} group by 1 having sum(n) >= {least_count}),
holes as materialized (select word, n, i, word[1:i] || word[i + 2:] as rest from (select word, n, unnest(range(length(word))) as i from words)),
near as (
    select a.word, b.word as other, b.n as other_n from holes a join holes b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select a.word, b.word, b.n from holes a join words b on a.rest = b.word
    union select b.word, a.word, a.n from holes a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, min(struct_pack(m := -other_n, w := other)) as top from near group by word),
known as materialized (select words.word, words.n, coalesce(n_near, 0) as n_near, case when -top.m >= {ratio} * words.n then top.w end as form,
    case when -top.m >= {ratio} * words.n then -top.m end as form_n from words left join best using (word)),
chain as (select word, word as root from known union all select chain.word, known.form from chain join known on known.word = chain.root where known.form is not null),
ends as (select chain.word, chain.root from chain join known on known.word = chain.root where known.form is null)
select known.word, form, root, n, n_near, form_n from known join ends using (word)"""
