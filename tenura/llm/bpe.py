"""Byte-level BPE: encoding by batched merge rounds in numpy, and decoding by gathering token bytes.

The text is cut into words by the vocabulary's pattern. All words of a batch that were not met before lie as one flat
array of symbols; a round looks up the rank of every adjacent pair by binary search over the sorted pair keys, takes
the lowest rank of each word and merges its occurrences from left to right. Words without a known pair leave. A merge
that uses a merged symbol always has a later rank, so all occurrences of a word's best pair can be merged at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_row_ranges, pieces

#: The pattern that the byte-level vocabularies cut words with. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes that a task's remembered segments may take, bytes of one besides its characters and ids, symbols merged at once.
REMEMBERED_BYTES, SEGMENT_BYTES, FLAT_SYMBOLS = 48 << 20, 160, 500_000
NO_RANK = np.iinfo(np.int64).max
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_signs() -> dict[str, int]:
    """The printable sign of each byte in byte-level vocabularies: itself, or the next free sign from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, signs = spec["model"]["vocab"], byte_signs()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.cut = regex.compile(PATTERN)
        # a word boundary is only sure before a space that a visible character follows
        self.unsure = re.compile(r" (?=\s|\Z)")
        self.unit = np.zeros(256, np.int64)
        for sign, byte in signs.items():
            self.unit[byte] = vocabulary[sign]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        size = 1 + max(max(vocabulary.values()), *self.specials.values()) if self.specials else 1 + max(vocabulary.values())
        of = [b""] * size
        for token, i in vocabulary.items():
            of[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        for token, i in self.specials.items():
            of[i] = token.encode()
        self.token_length = np.array([len(b) for b in of], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(of), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids, self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        segments, counts = [], []
        for text in texts:
            own = self.segments(text)
            segments.append(own)
            counts.append(len(own))
        distinct = set().union(*segments)
        if self.held > REMEMBERED_BYTES:
            self.forget()
        self.learn([s for s in distinct if s not in self.known])
        index = np.fromiter((i for own in segments for i in map(self.known.__getitem__, own)), np.int64, sum(counts))
        length = self.length[index]
        ends = np.concatenate([[0], np.cumsum(length)])
        at = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[per_row_ranges(self.start[index], length)], np.diff(ends[at])

    def segments(self, text: str) -> list[str]:
        """Parts of the text that are encoded independently; a special token is a part of its own."""
        if self.special_cut and self.special_cut.search(text):
            return [p for part in self.special_cut.split(text) if part for p in ([part] if part in self.specials else self.plain(part))]
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        return self.cut.findall(text) if self.unsure.search(text) else re.findall(" ?[^ ]+", text)

    def learn(self, segments: list[str]) -> None:
        """Encode segments not met before, in runs of bounded size."""
        words, owner = [], []
        for i, segment in enumerate(segments):
            own = [segment] if segment in self.specials else self.cut.findall(segment)
            words += own
            owner += [i] * len(own)
        at, ids, per_word = 0, [], []
        data = [w.encode() for w in words]
        sizes = np.cumsum([len(b) for b in data]) if data else np.zeros(0, np.int64)
        while at < len(words):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + FLAT_SYMBOLS, "right")))
            got, lengths = self.merge(data[at:to])
            if self.specials:
                for k in range(at, to):
                    if words[k] in self.specials and segments[owner[k]] == words[k]:
                        first = int(lengths[: k - at].sum())
                        got = np.concatenate([got[:first], [self.specials[words[k]]], got[first + lengths[k - at] :]])
                        lengths[k - at] = 1
            ids.append(got)
            per_word.append(lengths)
            at = to
        base = len(self.ids)
        lengths = np.bincount(np.array(owner, np.int64), np.concatenate(per_word) if per_word else None, len(segments)).astype(np.int64) if owner else np.zeros(len(segments), np.int64)
        self.known.update(zip(segments, range(len(self.length), len(self.length) + len(segments)), strict=True))
        self.held += sum(map(len, segments)) * 4 + len(segments) * SEGMENT_BYTES + 4 * sum(map(len, ids))
        self.ids = np.concatenate([self.ids, *(i.astype(np.int32) for i in ids)])
        self.start = np.concatenate([self.start, base + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over all words: their ids in one array, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.unit[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(symbols))  # order of the first byte, to put finished words back
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            if len(symbols) > 1:
                key = symbols[:-1] << 32 | symbols[1:]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = (self.keys[at] == key) & (word[:-1] == word[1:])
                rank[:-1][hit] = self.ranks[at[hit]]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            live = np.repeat(best < NO_RANK, np.diff(np.append(first, len(symbols))))
            if not live.all():
                done.append((place[~live], symbols[~live], word[~live]))
                rank, symbols, word, place = rank[live], symbols[live], word[live], place[live]
                best = best[best < NO_RANK]
                if not len(symbols):
                    break
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            take = rank == np.repeat(best, np.diff(np.append(first, len(symbols))))
            # of occurrences that overlap (aaa), every second from the left
            starts = np.flatnonzero(take & ~np.concatenate([[False], take[:-1]]))
            run = np.arange(len(take)) - np.repeat(starts, np.diff(np.append(starts, len(take)))) if len(starts) and starts[0] == 0 else None
            if run is None:
                run = np.arange(len(take)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(take))))])
            take &= run % 2 == 0
            symbols[take] = self.merged[rank[take]]
            keep = ~np.concatenate([[False], take[:-1]])
            symbols, word, place = symbols[keep], word[keep], place[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        place, symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes that the ids of all texts stand for, and how many each text has."""
        lengths = self.token_length[ids]
        data = self.token_bytes[per_row_ranges(self.token_start[ids], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return memoryview(np.ascontiguousarray(data)), np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def text_of(data: bytes) -> str:
    """Decoded text; bytes that are no UTF-8 become the replacement character."""
    return data.decode("utf-8", "replace")


def bpe_round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row; on demand also ``ids`` and the ``decoded`` text.

    Ids are hashed as little-endian unsigned 32-bit integers. Null and empty texts have no tokens and the hash of
    nothing; ids may be null, repeated rows are encoded each, other columns are not read. Nothing is shuffled.
    """
    more = ", ids array<int>" * with_ids + ", decoded string" * with_text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch, texts in pieces(batches, "text"):
            coder = coder or ByteBpe(path)
            ids, counts = coder.encode(texts.to_pylist())
            data, sizes = coder.decode(ids, counts)
            ids32 = np.ascontiguousarray(ids.astype("<u4"))
            raw, to, end = memoryview(ids32).cast("B"), np.cumsum(counts) * 4, np.cumsum(sizes)
            hashes, texts_out = [], []
            decoded = []
            for i in range(len(counts)):
                hashes.append(hashlib.sha256(raw[to[i] - 4 * counts[i] : to[i]]).hexdigest())
                own = text_of(bytes(data[end[i] - sizes[i] : end[i]]))
                decoded.append(hashlib.sha256(own.encode()).hexdigest())
                if with_text:
                    texts_out.append(own)
            columns = {"doc_id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(hashes), "decoded_sha256": pa.array(decoded)}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
            if with_text:
                columns["decoded"] = pa.array(texts_out, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")).mapInArrow(work, SCHEMA + more)
