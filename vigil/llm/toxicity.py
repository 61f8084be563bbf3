"""Toxicity by a factorization machine over hashed terms.

Terms are words and the first four and five letters of longer words, hashed to
a fixed number of slots. Besides a weight, each slot has a short vector; the
inner products of the vectors are the learnt weights of pairs of terms, so a
pair can count for more (or less) than its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import id_crc32, importable

SLOTS = 1 << 20
_WORDS = re.compile(r"[^\W\d_]+").findall


class Terms:
    """Slots of a text's distinct terms; remembers words, starts anew when full."""

    def __init__(self, wanted: np.ndarray | None = None, most: int = 300_000):
        self.known, self.most = {}, most
        self.wanted = None if wanted is None else {s: s for s in wanted.tolist()}    # one object a slot

    def _slots(self, word: str) -> tuple[int, ...]:
        import xxhash
        terms = [(word, 0)] + [(word[:n], n) for n in (4, 5) if len(word) > n]
        slots = [xxhash.xxh32_intdigest(t, seed) & (SLOTS - 1) for t, seed in terms]
        if self.wanted is not None:
            slots = [self.wanted[s] for s in slots if s in self.wanted]
        return tuple(slots)

    def of(self, text: str | None) -> np.ndarray:
        words = set(_WORDS((text or "").lower()))
        if len(self.known) + len(words) > self.most:
            self.known = {}
        self.known.update((w, self._slots(w)) for w in words.difference(self.known))
        get = self.known.__getitem__
        return np.array(sorted(set().union(*map(get, words))), np.int64)


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum w_i + sum over pairs <v_i, v_j>) over the
    distinct known slots i of a text."""

    slots: np.ndarray            # sorted slots that have weights
    bias: float
    weight: np.ndarray
    vector: np.ndarray           # (slots, rank)

    def rows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Flat positions of known slots, and the start of each text."""
        flat = np.concatenate([*texts, np.zeros(0, np.int64)])
        lengths = np.array([len(t) for t in texts], np.int64)
        at = np.minimum(np.searchsorted(self.slots, flat), max(len(self.slots) - 1, 0))
        known = self.slots[at] == flat if len(self.slots) else np.zeros(len(flat), bool)
        text = np.repeat(np.arange(len(texts)), lengths)[known]
        return at[known], np.searchsorted(text, np.arange(len(texts) + 1))

    @staticmethod
    def _sum(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)])
        return total[starts[1:]] - total[starts[:-1]]

    def logits(self, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.vector[at]
        s = self._sum(v, starts)
        pairs = 0.5 * ((s * s).sum(1) - self._sum((v * v).sum(1), starts))
        return self.bias + self._sum(self.weight[at], starts) + pairs, s

    def scores(self, texts: list[np.ndarray], terms: int = 1 << 17) -> np.ndarray:
        """Texts are taken ``terms`` terms at a time, as each has its vector."""
        size = np.cumsum([0] + [len(t) for t in texts])
        out, i = np.zeros(len(texts)), 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(size, size[i] + terms, "right")) - 1)
            z, _ = self.logits(*self.rows(texts[i:j]))
            out[i:j] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            i = j
        return out

    @classmethod
    def fit(cls, texts: list[np.ndarray], label: np.ndarray, share: float, rank: int = 6, least: int = 4,
            penalty: float = 0.66, steps: int = 300, epochs: int = 20, batch: int = 256, rate: float = 0.02,
            decay: float = 1e-5, seed: int = 5) -> "FactorizationMachine":
        """``share``: the positives' share among all labelled rows; the sample
        may hold more of them and is weighted back. Slots in fewer than
        ``least`` texts are unknown; every other slot may get a weight and has
        a vector, whatever its rate in the classes is. First the weights are
        fitted with an L1 penalty of ``penalty`` texts of the lighter class,
        then the vectors, by what the weights leave unexplained."""
        n1, n0 = float(label.sum()), float((1 - label).sum())
        if not n1 or not n0:
            return cls(np.zeros(0, np.int64), 4.0 if n1 else -4.0, np.zeros(0), np.zeros((0, rank)))
        slots = np.flatnonzero(np.bincount(np.concatenate([*texts, np.zeros(0, np.int64)]), minlength=SLOTS) >= least)
        m = cls(slots, float(np.log(share / (1 - share))), np.zeros(len(slots)), np.zeros((len(slots), rank)))
        weight = np.where(label == 1, share / n1, (1 - share) / n0)
        at, starts = m.rows(texts)
        m._fit_weights(at, starts, label, weight, penalty * weight.min(), steps)
        m._fit_vectors(at, starts, label, weight * len(label), epochs, batch, rate, decay, np.random.default_rng(seed))
        return m

    def _fit_weights(self, at: np.ndarray, starts: np.ndarray, label: np.ndarray, weight: np.ndarray, l1: float, steps: int) -> None:
        """Bias and sparse weights: accelerated proximal gradient steps, each
        slot with its own bound of the curvature."""
        k, owner = len(self.slots), np.repeat(np.arange(len(label)), np.diff(starts))
        curve = 0.25 * weight * (np.diff(starts) + 1)
        h = np.append(np.bincount(at, curve[owner], minlength=k), curve.sum())
        w = np.append(self.weight, self.bias)
        y, t, l1 = w, 1.0, np.append(np.full(k, l1), 0.0)
        for _ in range(steps):
            z = y[-1] + np.bincount(owner, y[at], minlength=len(label))
            d = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
            u = y - np.append(np.bincount(at, d[owner], minlength=k), d.sum()) / h
            new = np.sign(u) * np.maximum(np.abs(u) - l1 / h, 0)
            if ((y - new) * h).dot(new - w) > 0:             # overshot: start anew
                t = 1.0
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            y = new + (t - 1) / after * (new - w)
            w, t = new, after
        self.weight, self.bias = w[:-1], float(w[-1])

    def _fit_vectors(self, at: np.ndarray, starts: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int, batch: int,
                     rate: float, decay: float, r: np.random.Generator) -> None:
        k, rank = self.vector.shape
        self.vector = r.normal(0, 0.4 / np.sqrt(max(1.0, len(at) / len(label))), (k, rank))
        total, place = np.full((k, rank), 1e-3), np.zeros(k, np.int64)
        for _ in range(epochs):
            order = r.permutation(len(label))
            for first in range(0, len(order), batch):
                pick = order[first:first + batch]
                known = np.concatenate([at[starts[i]:starts[i + 1]] for i in pick])
                lengths = np.diff(starts)[pick]
                z, s = self.logits(known, np.append(0, np.cumsum(lengths)))
                d = weight[pick] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[pick]) / len(pick)
                own = np.unique(known)
                place[own] = np.arange(len(own))
                local, each, s, v = place[known], np.repeat(d, lengths), np.repeat(s, lengths, axis=0), self.vector[own]
                dv = np.stack([np.bincount(local, each * (s[:, c] - v[local, c]), minlength=len(own)) for c in range(rank)], 1) + decay * v
                total[own] += dv * dv
                self.vector[own] -= rate * dv / np.sqrt(total[own])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for b in batches:
        slots = [terms.of(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([s.astype("<i4").tobytes() for s in slots], pa.binary())],
                                         ["label", "slots"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_class: int = 2000, **options) -> FactorizationMachine:
    """Fit on at most ``rows_per_class`` labelled ids of each class (the bound of
    the sample: the first by a hash of the id). ``labels`` has doc_id and
    ``label``; rows with a null or another value than 0 and 1 are left out, of
    repeated labels the largest holds. Of several documents with one id the text
    with the smallest hash is learnt; ids without a document are not learnt."""
    importable(docs.sparkSession)
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # only hashes low enough for twice as many rows are ranked, so a class of any size is a small window
    h = F.shiftrightunsigned(F.xxhash64(F.lit(3), F.col("doc_id")), 11) / F.lit(2.0 ** 53)
    low = lambda y: F.lit(min(1.0, (2 * rows_per_class + 100) / max(1, count.get(y, 0))))
    drawn_first = Window.partitionBy("label").orderBy("_h", "doc_id")
    sample = (known.withColumn("_h", h).where(F.col("_h") < F.when(F.col("label") == 1, low(1)).otherwise(low(0)))
              .withColumn("_r", F.row_number().over(drawn_first)).where(F.col("_r") <= rows_per_class).select("doc_id", "label"))
    # at most 2 * rows_per_class rows of two integers, so a bounded side; a repeated id is reduced map-side
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    drawn = texts.mapInArrow(_hashed, "label int, slots binary").toArrow()
    texts = [np.frombuffer(s, "<i4").astype(np.int64) for s in drawn["slots"].to_pylist()]
    y = drawn["label"].to_numpy().astype(np.float64)
    rows = sum(count.values())
    share = min(max(count.get(1, 0) / rows if rows else 0.0, 1e-4), 1 - 1e-4)
    order = sorted(range(len(texts)), key=lambda i: (y[i], len(texts[i]), texts[i].tobytes()))
    return FactorizationMachine.fit([texts[i] for i in order], y[order], share, **options)


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (null: as empty) in column
    ``out``, which replaces one of that name. Empty texts score by the bias;
    repeated rows and ids are scored each by its own text; an empty table gives
    an empty result."""
    importable(docs.sparkSession)
    rest = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(model.slots)
        for b in batches:
            scores = np.concatenate([model.scores([terms.of(t) for t in b.column(text)[k:k + 256].to_pylist()])
                                     for k in range(0, b.num_rows, 256)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(scores, pa.float64())], [*rest, out])

    schema = docs.select(*rest).schema.add(out, "double")
    return docs.select(*rest).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", of: int = 5, remainder: int = 0):
    """Whether a row is kept from learning (false for a null id)."""
    return F.coalesce(F.pmod(id_crc32(F.col(doc_id)), F.lit(of)) == remainder, F.lit(False))
