"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two short windows counts the subsequences of four characters that both hold, where up to one further
character may stand in each gap; each gap costs the factor ``DECAY``. A window is the ``STARTS`` positions at which a
subsequence may begin. Letters are folded (case, accents, look-alike digits) and runs of other characters are one
separator, so inflected, gapped (``i.d.i.o.t``) and inserted-character insults stay close to the plain ones.

Training knows labels of documents only. Windows of clean sentences are negative; of every toxic document the windows
that look worst are positive, first by how character runs divide between the labels, then by the machine of the other
half of the documents; its hardest clean windows join the negatives. The kernel to the landmarks is a product of sparse vectors, so the trained
machine folds into one weight per subsequence: deciding is a table lookup and a sliding sum. A document is summed up by
its worst window and by how many windows pass some levels; a logistic curve fitted on documents kept from the machine
turns that into a score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import give_back, held_out, pieces

BITS, LENGTH = 5, 4
SIZE = 1 << BITS * LENGTH
STARTS, PAD, DECAY = 6, 16, 0.75
#: Decisions that windows are counted from.
LEVELS = (-0.5, 0.0, 0.5, 1.0)
#: Texts up to this length count as equally long, so the curve says nothing against shortness itself.
SHORT = 300
#: Labelled documents of each class that training reads at most, and characters of each of them.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 40_000
LANDMARKS, ROUNDS, POSITIVES, HARD, EASY = 96, 3, 3, 2, 4
#: Characters that are looked at together, and numbers of a matrix of windows that are held at once.
RUN_CHARS, CELLS = 1 << 18, 1 << 20
GAPS = [np.cumsum((0, *gap)) for gap in product((1, 2), repeat=LENGTH - 1)]
WEIGHTS = [DECAY ** int(gap[-1] - (LENGTH - 1)) for gap in GAPS]
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def _fold_table(size: int = 0x250) -> np.ndarray:
    """Code of every low code point: 1 to 26 for letters without case and accents, 27 for other letters, else 0."""
    codes = np.zeros(size + 1, np.uint32)
    for point in range(size):
        char = LOOK_ALIKE.get(chr(point), chr(point)).lower()
        base = unicodedata.normalize("NFD", {"ß": "s", "æ": "a", "ø": "o"}.get(char, char))[0]
        codes[point] = ord(base) - 96 if "a" <= base <= "z" else 27 if base.isalpha() else 0
    codes[size] = 28  # letters and signs of other scripts
    return codes


FOLD = _fold_table()


def _together(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of neighbours that have RUN_CHARS characters at most (a larger one is alone)."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + RUN_CHARS, "right")) - 1)
        yield at, to
        at = to


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts (a byte each), each followed by PAD separators, and where each text begins (one more entry)."""
    found = [_folded(texts[a:b]) for a, b in _together(np.array([len(t) for t in texts], np.int64))]
    sizes = np.concatenate([np.zeros(1, np.int64), *[own for _, own in found]])
    return np.concatenate([np.zeros(0, np.uint8), *[codes for codes, _ in found]]), np.cumsum(sizes)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of these texts, and how many each has."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = FOLD[np.minimum(points, len(FOLD) - 1)]
    text = np.repeat(np.arange(len(texts)), lengths)
    begins = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
    keep = (codes > 0) | begins | np.concatenate([[True], codes[:-1] > 0])[: len(codes)]
    codes, text = codes[keep], text[keep]
    codes, text = _joined(codes, text)
    sizes = np.bincount(text, minlength=len(texts)) + PAD + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    out[np.arange(len(codes)) + (PAD + 1) * text + 1] = codes  # a text begins with a separator
    return out, sizes


def _joined(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single letters that separators hold apart become one word (``i.d.i.o.t``)."""
    if len(codes) < 3:
        return codes, text
    gap = codes == 0
    drop = np.zeros(len(codes), bool)
    drop[1:-1] = gap[1:-1] & ~gap[:-2] & ~gap[2:] & (text[:-2] == text[2:])
    alone = np.zeros(len(codes), bool)  # a letter between two separators, or at an end of the text
    inner = np.concatenate([[True], text[1:] != text[:-1]]) | np.concatenate([[True], gap[:-1]])
    alone = ~gap & inner & (np.concatenate([gap[1:], [True]]) | np.concatenate([text[1:] != text[:-1], [True]]))
    drop[1:-1] &= alone[:-2] & alone[2:]
    return codes[~drop], text[~drop]


def subsequences(codes: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """For every position but the last PAD the subsequence that begins there with these offsets."""
    n = len(codes) - PAD
    found = codes[gap[0] : gap[0] + n].astype(np.uint32)
    for offset in gap[1:]:
        found = found << BITS | codes[offset : offset + n]
    return found


def decisions(weights: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The sliding decision (without bias) of the window that begins at each position but the last PAD."""
    total = np.zeros(len(codes) - PAD, np.float32)
    for gap, weight in zip(GAPS, WEIGHTS, strict=True):
        total += weights[subsequences(codes, gap)] * np.float32(weight)
    out = np.zeros_like(total)
    for k in range(STARTS):
        out[: len(total) - k] += total[k:]
    return out


def _by_runs(codes: np.ndarray, starts: np.ndarray, values: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """For runs of texts: the first, the one behind the last, and ``values`` of their codes as among all texts.

    The codes behind a run that its last windows reach are passed on too, so no value depends on how texts are cut.
    """
    for a, b in _together(np.diff(starts)):
        yield a, b, values(codes[starts[a] : starts[b] + 2 * PAD])[: starts[b] - starts[a]]


def _decided(weights: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda codes: np.append(decisions(weights, codes), np.full(PAD, -1e9, np.float32))


def summaries(weights: np.ndarray, bias: float, texts: list[str]) -> np.ndarray:
    """Per text: the highest decision, how many separate windows pass each of LEVELS, and the length (logarithms)."""
    if not texts:
        return np.zeros((0, 2 + len(LEVELS)))
    codes, starts = folded(texts)
    found = [_summed(value + np.float32(bias), starts[a : b + 1] - starts[a]) for a, b, value in _by_runs(codes, starts, _decided(weights))]
    return np.concatenate(found)


def _summed(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    value[(starts[1:, None] - np.arange(1, PAD - 3)).ravel()] = -1e9  # windows that would reach into the next text
    texts = starts[1:]
    out = np.empty((len(texts), 2 + len(LEVELS)))
    out[:, 0] = np.maximum.reduceat(value, starts[:-1])
    out[:, -1] = np.log(np.maximum(np.diff(starts) - PAD, SHORT))
    at = np.flatnonzero(value > LEVELS[0])
    text = np.searchsorted(starts, at, "right") - 1
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) > STARTS) | (text[1:] != text[:-1])])) if len(at) else at
    peaks = np.maximum.reduceat(value[at], first) if len(at) else value[at]
    for k, level in enumerate(LEVELS):
        out[:, 1 + k] = np.log1p(np.bincount(text[first], peaks > level, len(texts)))
    return out


@dataclass
class Model:
    """weights: one per subsequence, the machine's; curve: weights of a document's summary and, last, the shift."""

    weights: np.ndarray | None
    bias: float
    curve: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.curve[-1])
        return 1 / (1 + np.exp(-np.clip(summaries(self.weights, self.bias, texts) @ self.curve[:-1] + self.curve[-1], -500, 500)))


def _vectors(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The subsequences of the windows that begin at ``at``: one row each, columns in the order of _entry_weights."""
    out = np.empty((len(at), STARTS * len(GAPS)), np.uint32)
    for g, gap in enumerate(GAPS):
        for k in range(STARTS):
            found = codes[at + k + gap[0]].astype(np.uint32)
            for offset in gap[1:]:
                found = found << BITS | codes[at + k + offset]
            out[:, g * STARTS + k] = found
    return out


def _entry_weights() -> np.ndarray:
    return np.repeat(WEIGHTS, STARTS).astype(np.float64)


class Landmarks:
    """Chosen windows; the kernel of any window to them; the map to the space where that kernel is a dot product."""

    def __init__(self, vectors: np.ndarray):
        self.known, local = np.unique(vectors, return_inverse=True)
        self.dense = np.zeros((len(self.known) + 1, len(vectors)))
        rows = np.repeat(np.arange(len(vectors)), vectors.shape[1])
        np.add.at(self.dense, (local.ravel(), rows), np.tile(_entry_weights(), len(vectors)))
        self.dense[:-1] /= np.sqrt((self.dense[:-1] ** 2).sum(0))
        values, axes = np.linalg.eigh(self.dense.T @ self.dense)
        good = values > 1e-6 * values[-1]
        self.root = axes[:, good] / np.sqrt(values[good])

    def features(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(vectors), self.root.shape[1]))
        for at in range(0, len(vectors), 500):
            some = vectors[at : at + 500]
            local = np.minimum(np.searchsorted(self.known, some), len(self.known) - 1)
            local = np.where(self.known[local] == some, local, len(self.known))
            out[at : at + 500] = np.einsum("nkm,k->nm", self.dense[local], _entry_weights()) @ self.root
        return out

    def fold(self, weight: np.ndarray) -> np.ndarray:
        table = np.zeros(SIZE, np.float32)
        table[self.known] = self.dense[:-1] @ (self.root @ weight)
        return table


def svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine, both classes of equal weight, by Newton steps. Returns weights and bias."""
    z = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, cost / max(1, (y > 0).sum()), cost / max(1, (y < 0).sum())) * 100
    w, ridge = np.zeros(z.shape[1]), np.append(np.ones(x.shape[1]), 1e-6)
    for _ in range(steps):
        margin = 1 - y * (z @ w)
        live = margin > 0
        gradient = ridge * w - 2 * (z[live] * (share * y * margin)[live, None]).sum(0)
        hessian = np.diag(ridge) + 2 * (z[live] * share[live, None]).T @ z[live]
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _top(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Positions of each text's highest windows that don't overlap."""
    out = []
    for a, b in zip(starts[:-1], starts[1:] - PAD, strict=True):
        own = values[a:b].copy()
        for _ in range(count):
            if not len(own) or not np.isfinite(best := own[k := int(own.argmax())]) or best <= -1e8:
                break
            out.append(a + k)
            own[max(0, k - STARTS) : k + STARTS] = -1e9
    return np.array(out, np.int64)


def _top_of(codes: np.ndarray, starts: np.ndarray, values: Callable[[np.ndarray], np.ndarray], count: int) -> np.ndarray:
    """_top of the values of all texts, which are worked out run by run."""
    found = [starts[a] + _top(value, starts[a : b + 1] - starts[a], count) for a, b, value in _by_runs(codes, starts, values)]
    return np.concatenate(found)


def _spread(vectors: np.ndarray, count: int) -> np.ndarray:
    """Windows far from each other by the kernel: each next one is the least like those chosen."""
    known, local = np.unique(vectors, return_inverse=True)
    local = local.reshape(vectors.shape)
    step = max(1, CELLS // len(known))
    norms = np.concatenate([np.sqrt((_scatter(local[a : a + step], len(known)) ** 2).sum(1)) for a in range(0, len(vectors), step)])
    chosen, like = [], np.zeros(len(vectors))
    at = int(norms.argmax())
    for _ in range(min(count, len(vectors))):
        chosen.append(at)
        weight = _scatter(local[[at]], len(known))[0] / norms[at]
        like = np.maximum(like, (weight[local] * _entry_weights()).sum(1) / norms)
        at = int(like.argmin())
        if like[at] > 0.98:
            break
    return vectors[chosen]


def _scatter(local: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(local), size))
    np.add.at(out, (np.repeat(np.arange(len(local)), local.shape[1]), local.ravel()), np.tile(_entry_weights(), len(local)))
    return out


def _runs(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many texts hold each run of four characters."""
    out = np.zeros(SIZE, np.int64)
    for a, b, found in _by_runs(codes, starts, lambda codes: subsequences(codes, GAPS[0])):
        text = np.repeat(np.arange(b - a), np.diff(starts[a : b + 1]))[: len(found)]
        pairs = np.unique(text.astype(np.int64) << BITS * LENGTH | found)
        out += np.bincount(pairs & SIZE - 1, minlength=SIZE)
    return out


def _inside(starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Positions of the windows with these numbers, counting those that begin within a text."""
    before = starts - PAD * np.arange(len(starts))
    return place + PAD * (np.searchsorted(before, place, "right") - 1)


def _other_half(codes: np.ndarray, starts: np.ndarray, machines: list[tuple[np.ndarray, float] | None]) -> np.ndarray:
    """The windows of each text that look worst to the machine of the other half, where that has one, of those near the worst."""
    found = []
    for a, b in _together(np.diff(starts)):
        own, local = np.full(starts[b] - starts[a], -1e9, np.float32), starts[a : b + 1] - starts[a]
        half = np.repeat(np.arange(a, b) % 2, np.diff(local))
        for k, machine in enumerate(machines):
            if machine is not None:
                value = _decided(machine[0])(codes[starts[a] : starts[b] + 2 * PAD])[: len(own)] + machine[1]
                own[half != k] = value[half != k]
        best = np.maximum.reduceat(own, local[:-1])
        chosen = _top(own, local, POSITIVES)
        found.append(starts[a] + chosen[own[chosen] >= np.clip(best[np.searchsorted(local, chosen, "right") - 1], -0.5, 0)])
    return np.concatenate(found)


def train(toxic: list[str], clean: list[str], check_toxic: list[str], check_clean: list[str], seed: int = 7) -> Model:
    """Fit the machine on the first two lists and the curve on the others. Without both classes: the share of toxic ones."""
    if not toxic or not clean:
        total = len(toxic) + len(clean)
        return Model(None, 0.0, np.array([len(toxic) / total if total else 0.0]))
    rng = np.random.default_rng(seed)
    bad, good = folded(toxic), folded(clean)
    a, b = _runs(*bad), _runs(*good)
    odds = np.log((a + 0.5) / (len(toxic) + 1)) - np.log((b + 0.5) / (len(clean) + 1))
    table = np.where(a >= 2, np.clip(odds, 0, None) * np.sqrt(a), 0).astype(np.float32)
    del a, b, odds
    plain = lambda codes: np.append(table[subsequences(codes, GAPS[0])], np.zeros(PAD, np.float32))
    slide = lambda x: sum(np.append(x[k:], np.zeros(k, np.float32)) for k in range(STARTS))
    hard = _vectors(good[0], _top_of(*good, lambda codes: slide(plain(codes)), 1))
    inside = len(good[0]) - PAD * len(clean)
    easy = _vectors(good[0], _inside(good[1], rng.choice(inside, min(inside, EASY * len(clean)), replace=False)))
    at = _top_of(*bad, lambda codes: slide(plain(codes)), 1)
    for _ in range(ROUNDS - 1):
        # the windows of each half of the toxic documents are chosen by the machine of the other half
        machines = []
        for half in (0, 1):
            of = lambda at: (np.searchsorted(bad[1], at, "right") - 1) % 2 == half  # noqa: B023, E731
            if not of(at).any() or of(at).all():
                machines.append(None)
                continue
            machines.append(_machine(_vectors(bad[0], at[of(at)]), hard, easy))
            hard = np.unique(np.vstack([hard, _vectors(good[0], _top_of(*good, _decided(machines[-1][0]), HARD))]), axis=0)
        chosen = _other_half(*bad, machines)
        at = chosen if len(chosen) else at
    weights, bias = _machine(_vectors(bad[0], at), hard, easy)
    toxic, clean = check_toxic or toxic, check_clean or clean
    x = np.vstack([summaries(weights, bias, toxic), summaries(weights, bias, clean)])
    return Model(weights, bias, logistic(x, np.repeat([1.0, 0.0], [len(toxic), len(clean)])))


def _machine(positive: np.ndarray, hard: np.ndarray, easy: np.ndarray) -> tuple[np.ndarray, float]:
    """The weight of every subsequence, and the bias."""
    marks = Landmarks(np.unique(np.vstack([_spread(positive, LANDMARKS * 2 // 3), _spread(hard, LANDMARKS // 3)]), axis=0))
    w, bias = svm(marks.features(np.vstack([positive, hard, easy])), np.repeat([1.0, -1.0], [len(positive), len(hard) + len(easy)]))
    return marks.fold(w), bias


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 100) -> np.ndarray:
    """Weights of the columns and, last, the shift of the logistic curve; targets are smoothed, columns scaled."""
    ones, zeros = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    middle, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6) * len(x) / 10
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - target) + penalty * w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * middle / scale).sum())


def training_texts(docs: DataFrame, labels: DataFrame, count: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """Texts of at most ``count`` labelled documents of each class, in the order of a hash of their ids.

    Held-out rows are left out. Of a text longer than SAMPLE_CHARS, lines and sentences spread over all of it are taken.
    Every fourth document is kept for the curve. Only these bounded texts come to the driver.
    """
    rows = labels.where(~held_out(labels.doc_id) & labels.doc_id.isNotNull()).select(labels.doc_id.cast("long").alias("id"), labels.toxic.cast("int").alias("label"))
    mixed = F.xxhash64(F.col("id"), F.lit("toxicity"))
    ids = None
    for label in (0, 1):
        some = rows.where(F.col("label") == label).groupBy("id").agg(F.max("label").alias("label")).select("id", "label", mixed.alias("mixed")).orderBy("mixed", "id").limit(count)
        ids = some if ids is None else ids.unionByName(some)
    parts = F.split("text", r"(?<=[.!?\n])\s+")
    every = F.ceil(F.length("text") / SAMPLE_CHARS).cast("int")
    spread = F.array_join(F.filter(parts, lambda p, i: i % every == 0), "\n")
    text = F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(F.substring(spread, 1, SAMPLE_CHARS))
    # at most 2 * count ids are broadcast
    found = docs.select(docs.doc_id.cast("long").alias("id"), docs.text).where("text is not null").join(F.broadcast(ids), "id").select("id", "label", "mixed", text.alias("text"))
    out: dict[str, list[str]] = {"toxic": [], "clean": [], "check_toxic": [], "check_clean": []}
    for row in sorted(found.collect(), key=lambda r: (r.mixed, r.id, r.text)):
        out[("check_" if row.mixed % 4 == 0 else "") + ("toxic" if row.label else "clean")].append(row.text)
    return out


def fit(docs: DataFrame, labels: DataFrame, count: int = SAMPLE_DOCS) -> Model:
    texts = training_texts(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), count)
    model = train(**texts)
    del texts
    give_back()
    return model


def score(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; with ``keep`` instead the input's columns of rows not predicted.

    Null and empty texts get the score of a text without any subsequence; a null id is not held out. Repeated rows are
    scored each. Nothing is shuffled; the broadcast model has a fixed size of 4 MB.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if keep:
        name = "text"

        def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches, name, 2 << 20):
                good = shared.value.scores(texts.to_pylist()) < 0.5
                yield batch.filter(pa.array(good))

        return docs.mapInArrow(select, docs.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 2 << 20):
            found = shared.value.scores(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs.doc_id.cast("long").alias("doc_id"), held_out(docs.doc_id).alias("held_out"), docs.text)
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
