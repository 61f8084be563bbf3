"""Order-preserving packing by dynamic programming.

Documents stay in the order in which a partition holds them. Windows may be
cut at document ends, at sentence ends (a small penalty, as a document is
truncated) and, where neither is near, at any token (a larger one). The window
cuts that minimise padding plus penalties come from one pass of dynamic
programming: the cost of a window is linear in its start, so a monotone queue
holds the candidate starts. Each task packs its own rows; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.tokens import Encoder

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "input_ids array<int>")


def best_cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Indices into ``at`` (increasing positions, the first is 0, gaps at most
    ``size``) where windows end, the last included: the windows are at most
    ``size`` long and minimise padding plus the penalties of the cuts. The last
    window is not charged for padding."""
    at, penalty = at.tolist(), penalty.tolist()
    n = len(at)
    before, base = [0] * n, [0.0] * n            # base: cost so far + position, what a later window sees of its start
    queue = deque([0])
    for j in range(1, n - 1):
        here = at[j]
        while here - at[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        before[j] = i
        value = base[j] = base[i] + size + penalty[j]
        while queue and base[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    if n > 1:
        start = np.searchsorted(at, at[-1] - size)
        before[-1] = min(range(int(start), n - 1), key=lambda i: (base[i] - at[i], -i))
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(j)
        j = before[j]
    return cuts[::-1]


def _powers(length: int) -> list[int]:
    """``length`` as powers of two, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class Packer:
    """Packs a stream of documents; ``take`` gives the pieces of finished windows."""

    def __init__(self, size: int, sentence: float, anywhere: float, ends: np.ndarray):
        self.size, self.sentence, self.anywhere, self.ends = size, sentence, anywhere, ends
        self.step, self.next = max(1, size // 64), 0
        self.docs: list[tuple] = []              # (doc_id, tokens before, ids, tokens in all)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)

    def take(self, last: bool) -> dict[str, list] | None:
        """Cut what is held; but for the last call the last window stays."""
        if not self.docs:
            return None
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(d[2]) for d in self.docs])
        cost = np.full(len(ids) + 1, np.inf)
        cost[1:][self.ends[ids]] = self.sentence
        cost[ends] = 0
        cost[0] = 0
        at = np.flatnonzero(cost < np.inf)
        if len(wide := np.flatnonzero(np.diff(at) > self.step)):
            for w in wide.tolist():
                more = np.arange(at[w] + self.step, at[w + 1], self.step)
                cost[more] = self.anywhere
            at = np.flatnonzero(cost < np.inf)
        cuts = at[best_cuts(at, cost[at], self.size)].tolist()
        if last:
            tail = cuts.pop() - (start := cuts[-1] if cuts else 0)
            for p in [tail] if tail == self.size else _powers(tail):
                cuts.append(start := start + p)
        elif len(cuts) > 1:
            cuts.pop()
        else:
            return None
        out = self._pieces(ids, ends, np.array(cuts))
        self._drop(cuts[-1])
        return out

    def _pieces(self, ids, ends, cuts) -> dict[str, list]:
        done = int(cuts[-1])
        edges = np.union1d(np.concatenate([[0], ends[ends < done]]), cuts)
        starts, stops = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, starts, "right")
        seq = np.searchsorted(cuts, starts, "right")
        seq_start, doc_start = np.concatenate([[0], cuts])[seq], np.concatenate([[0], ends])[doc]
        docs = [self.docs[d] for d in doc.tolist()]
        pieces = [ids[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        out = {"doc_id": [d[0] for d in docs],
               "start": [d[1] + s for d, s in zip(docs, (starts - doc_start).tolist(), strict=True)],
               "length": (stops - starts).tolist(),
               "ids_crc32": [zlib.crc32(np.ascontiguousarray(p, "<u4").tobytes()) for p in pieces],
               "doc_tokens": [d[3] for d in docs], "sequence_id": (seq + self.next).tolist(),
               "offset": (starts - seq_start).tolist(), "input_ids": pieces}
        self.next += len(cuts)
        return out

    def _drop(self, n: int) -> None:
        """Forgets the first ``n`` tokens held."""
        self.held -= n
        gone = 0
        while n and len(self.docs[gone][2]) <= n:
            n -= len(self.docs[gone][2])
            gone += 1
        del self.docs[:gone]
        if n:
            doc_id, before, ids, total = self.docs[0]
            self.docs[0] = (doc_id, before + n, ids[n:], total)


def _packer(path: str, end_id: int, size: int, sentence: float, anywhere: float, chunk: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first_id = TaskContext.get().partitionId() << 40
        encoder = Encoder(path)
        packer = Packer(size, sentence, anywhere, encoder.sentence_ends())

        def rows(out) -> pa.RecordBatch:
            lists = out.pop("input_ids")
            flat = np.concatenate(lists).astype(np.int32) if with_ids else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(out["length"])]) if with_ids else np.zeros(len(lists) + 1)
            out["sequence_id"] = [first_id + s for s in out["sequence_id"]]
            arrays = [pa.array(v, pa.int64()) for v in out.values()]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(offsets.astype(np.int32), flat)], [*out, "input_ids"])

        end = np.array([end_id], "<u4")
        for b in batches:
            doc_ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for k in range(0, len(texts), 256):
                for doc_id, ids in zip(doc_ids[k:k + 256], encoder.encode([t or "" for t in texts[k:k + 256]]), strict=True):
                    packer.add(doc_id, np.concatenate([ids, end]))
                if packer.held >= chunk and (out := packer.take(False)):
                    yield rows(out)
        if out := packer.take(True):
            yield rows(out)
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 2048, sentence_penalty: float = 4.0,
         cut_penalty: float = 24.0, chunk: int = 1 << 20, with_ids: bool = True) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are ignored) into sequences of
    at most ``size`` tokens.

    A document is its text's ids (null: none) and ``end_id``. Returns a row per
    piece: doc_id, start (tokens of the document before it), length, ids_crc32
    (of the ids as little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset (place in the sequence) and, ``with_ids``, input_ids.
    The windows of about ``chunk`` tokens are chosen at once; the last tokens of
    a partition go to sequences whose lengths are powers of two, which need no
    padding. A null doc_id stays null; repeated rows are packed each; a document
    longer than ``size`` spans several sequences; an empty table gives none.
    """
    run = _packer(tokenizer_path, end_id, size, sentence_penalty, cut_penalty, chunk, with_ids)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
    return out if with_ids else out.drop("input_ids")
