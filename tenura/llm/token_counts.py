"""Token counts of whole texts with a sentencepiece model of merges.

Every text is encoded in overlapping chunks with offsets, whatever its size; one that fits a chunk is a single one. Two
neighbouring chunks are spliced where both have the same token at the same place. That boundary is stable: byte-pair
encoding is decided by adjacent pairs alone (a token sequence is the encoding of its text exactly if every adjacent
pair is the encoding of its own text), and each adjacent pair of the spliced sequence occurs in one of the two chunks'
encodings. When the overlap has no such token, it is widened up to the chunk; where that fails too (a run of one
letter, say), the text is taken again in chunks of twice the size, at last as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces

#: Bytes of a chunk beyond its overlap, and of the first overlap.
CHUNK_BYTES, OVERLAP_BYTES = 1 << 10, 1 << 6
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

Token = tuple[int, int, int]  #: begin, end, id; places in bytes


class Chunk:
    """Tokens of the bytes from ``begin`` to ``end``; places are worked out only where they are asked for.

    ``widths`` are the bytes of text behind each token, but that the first one counts the space that the model puts
    before a chunk, which takes no byte of the text.
    """

    def __init__(self, begin: int, end: int, ids: list[int], widths: Callable[[int], int]):
        self.begin, self.end, self.ids, self.widths = begin, end, ids, widths
        self.count = len(ids)

    def head(self, stop: int) -> list[Token]:
        """The tokens that begin before ``stop``."""
        found: list[Token] = []
        at = self.begin - 1
        for k, name in enumerate(self.ids):
            if at >= stop:
                break
            found.append((max(at, self.begin), at := at + self.widths(k), name))
        return found

    def tail(self, start: int) -> tuple[int, list[Token]]:
        """The tokens that end behind ``start``, and the number of the first of them."""
        found: list[Token] = []
        at, k = self.end, self.count
        while k and at > start:
            k -= 1
            found.append((max(at - self.widths(k), self.begin), at, self.ids[k]))
            at -= self.widths(k)
        return k, found[::-1]


class Counter:
    """Counts tokens with one loaded model."""

    def __init__(self, model_path: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = max(chunk, 8), max(overlap, 1)
        size = self.model.get_piece_size()
        #: Does the model take texts as they are, but for one space in front? Else there are no offsets to splice by.
        self.keeps_text = self.model.normalize(" a  b\t\né ") == "▁▁a▁▁b\t\né▁"
        self.unknown = self.model.unk_id()
        #: Single bytes of a character without a piece of its own.
        self.bytes = {i for i in range(size) if self.model.is_byte(i)}
        #: Bytes of text behind each piece.
        self.widths = [1 if i in self.bytes else len(self.model.id_to_piece(i).replace("▁", " ").encode()) for i in range(size)]

    def count(self, text: str) -> int:
        """The library's number of tokens."""
        if not text or not self.keeps_text:
            return len(self.model.encode(text))
        data, size = text.encode(), self.chunk
        while (found := self._spliced(data, size)) is None:
            size *= 2
        return found

    def _spliced(self, data: bytes, size: int) -> int | None:
        """Tokens of all chunks of ``size``; none where two neighbours have no stable boundary in common."""
        left = self._encoded(data, 0, size)
        counted = first = 0
        while left.end < len(data):
            overlap, joint = self.overlap, None
            while joint is None:
                back = _char_start(data, left.end - overlap)
                if back <= left.begin:
                    return None
                right = self._encoded(data, back, left.end + size)
                joint = self._common(left, right, first)
                overlap *= 2
            counted += joint[0] - first
            left, first = right, joint[1]
        return counted + left.count - first

    def _encoded(self, data: bytes, begin: int, end: int) -> Chunk:
        end = _char_start(data, end)
        text = data[begin:end].decode()
        ids = self.model.encode(text)
        if "▁" not in text and self.unknown not in ids:
            return Chunk(begin, end, ids, lambda k: self.widths[ids[k]])
        # the model's own sign for a space, or characters without a piece: their widths are only known to the library
        found = self.model.encode(text, return_type="proto").pieces
        ends = [-1, *[p.end for p in found]]
        return Chunk(begin, end, ids, lambda k: ends[k + 1] - ends[k])

    def _common(self, left: Chunk, right: Chunk, first: int) -> tuple[int, int] | None:
        """The last token from ``first`` on that stands in both: (number in left, number in right)."""
        right_tokens = right.head(left.end)
        number, left_tokens = left.tail(right.begin)
        # the first token of a chunk may owe its form to the space before it
        places = {token: j for j, token in enumerate(right_tokens) if j and self._whole(right_tokens, j)}
        for i in range(len(left_tokens) - 1, max(first - number, 0), -1):
            if (j := places.get(left_tokens[i])) is not None and self._whole(left_tokens, i):
                return number + i, j
        return None

    def _whole(self, tokens: list[Token], i: int) -> bool:
        """With a text of its own and no neighbour of single bytes: there, places are not those of characters."""
        (begin, end, name), (before, at, last) = tokens[i], tokens[i - 1]
        return end > begin and at > before and name not in self.bytes and last not in self.bytes


def _char_start(data: bytes, at: int) -> int:
    """The first character that begins at or before ``at``."""
    at = min(at, len(data))
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text",
                 chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> DataFrame:
    """One row per input row: its id, bytes, tokens, and whether the tokens exceed ``limit``.

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows are counted each; an empty
    table gives an empty table; other columns are not read. Rows never move, so nothing is shuffled. A model that
    changes texts before it encodes them (letter forms, runs of spaces) gives no offsets to splice by; with such a one
    each text is encoded as a whole.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counter = None
        for batch, texts in pieces(batches, "text"):
            counter = counter or Counter(model_path, chunk, overlap)
            counts = pa.array(list(map(counter.count, texts.to_pylist())), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pc.binary_length(texts).cast(pa.int64()), counts, pc.greater(counts, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")).mapInArrow(work, SCHEMA)
