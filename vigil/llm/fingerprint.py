"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A paragraph is a line, cut further after the ends of sentences and after words
(in long runs without spaces: characters) that a hash picks, about one in
eight. Cuts depend on what stands there, not on positions, so that an edit
changes the paragraphs around it only. A paragraph's digest (a hash with its
length in the low bits) is added to one cell in each of three parts of a table:
count, xor of digests, xor of checks.

A fingerprint has about as many cells as its text has paragraphs. Two of them are
folded to the smaller number of cells and subtracted; peeling cells that hold a
single digest recovers the digests that only one version has, and their
lengths, from which the likeness follows. If cells remain, the difference was
too large for these sketches: both texts are sketched again with twice the cells.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import importable, seeded64

PARTS = 3
CELLS = 12                     # fewest cells of a fingerprint: PARTS times a power of two
RUN = 64                       # longer runs without a space are cut within
_LENGTH_BITS = 20
_LENGTH = (1 << _LENGTH_BITS) - 1
_CELL_BYTES = 16


class _Ends:
    """Whether a word ends a paragraph; remembers words, starts anew when full."""

    def __init__(self, most: int = 200_000):
        self.known: dict[str, bool] = {}
        self.most = most

    def __call__(self, word: str) -> bool:
        end = self.known.get(word)
        if end is None:
            if len(self.known) >= self.most:
                self.known.clear()
            end = self.known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & 7 == 0
        return end


_ends_paragraph = _Ends()


def _cut_run(run: str) -> list[str]:
    """A run without spaces, cut after characters that a hash of them and the
    three before picks."""
    c = np.frombuffer(run.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    window = np.zeros(len(c), np.uint64)
    for back in range(4):
        window[back:] ^= seeded64(c[:len(c) - back], 50 + back)
    at = np.flatnonzero(seeded64(window, 60) & np.uint64(31) == 0) + 1
    edges = [0, *at[at < len(run)].tolist(), len(run)]
    return [run[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)]


def paragraphs(text: str) -> list[str]:
    """The paragraphs of a text, without empty ones; none is longer than the
    length field holds."""
    for end in (". ", "! ", "? "):
        text = text.replace(end, end[0] + "\n")
    parts = []
    for line in text.split("\n"):
        if len(line) < RUN:
            if line:
                parts.append(line)
            continue
        held: list[str] = []
        for word in line.split(" "):
            if len(word) > RUN:
                *whole, word = _cut_run(word)
                if whole:
                    parts += [" ".join([*held, whole[0]]), *whole[1:]]
                    held = []
            held.append(word)
            if _ends_paragraph(word):
                parts.append(" ".join(held))
                held = []
        parts.append(" ".join(held))
    if any(len(p) > _LENGTH for p in parts):
        parts = [p[k:k + _LENGTH] for p in parts for k in range(0, len(p), _LENGTH)]
    return [p for p in parts if p]


def digests(parts: list[str]) -> np.ndarray:
    """One distinct digest per paragraph: its n-th occurrence differs from the
    first, so that the sketch is of the multiset."""
    import xxhash
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64)
    length = np.array([len(p) for p in parts], np.uint64)
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    nth = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    s = np.where(nth > 0, seeded64(s ^ nth.astype(np.uint64), 9), s)
    return np.unique((s & ~np.uint64(_LENGTH)) | length[order])


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """(PARTS, keys) cells of each digest, one in each part: the low bits of a
    hash, so that halving a table folds its second half onto the first."""
    part = cells // PARTS
    return np.stack([(seeded64(keys, 31 + i) & np.uint64(part - 1)).astype(np.int64) + i * part for i in range(PARTS)])


def cells_for(paragraph_count: int) -> int:
    """Cells of the fingerprint of so many paragraphs."""
    cells = CELLS
    while cells < paragraph_count:
        cells *= 2
    return cells


def _check(keys: np.ndarray) -> np.ndarray:
    """32 bits, as a stored cell has."""
    return seeded64(keys, 77) >> np.uint64(32)


class Sketches:
    """Sketches of many digest sets side by side: arrays (sets, cells)."""

    def __init__(self, sets: list[np.ndarray], cells: int):
        self.cells = cells
        self.count = np.zeros(len(sets) * cells, np.int64)
        self.xor = np.zeros(len(sets) * cells, np.uint64)
        self.check = np.zeros(len(sets) * cells, np.uint64)
        keys = np.concatenate([*sets, np.zeros(0, np.uint64)])
        self.toggle(keys, np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.ones(len(keys), np.int64))

    def toggle(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        check = _check(keys)
        for place in _places(keys, self.cells):
            at = owner * self.cells + place
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.xor, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    def subtract(self, other: "Sketches") -> "Sketches":
        self.count -= other.count
        self.xor ^= other.xor
        self.check ^= other.check
        return self

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Recovered digests with their set and side (1: the first has it, -1:
        the other)."""
        keys, owners, sides = [], [], []
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (_check(self.xor) == self.check))
            if not len(pure):
                break
            owner, key, side = pure // self.cells, self.xor[pure], self.count[pure]
            pick = np.lexsort((key, owner))
            new = np.concatenate([[True], (key[pick][1:] != key[pick][:-1]) | (owner[pick][1:] != owner[pick][:-1])])
            pick = pick[new]
            key, owner, side = key[pick], owner[pick], side[pick]
            self.toggle(key, owner, -side)
            keys.append(key)
            owners.append(owner)
            sides.append(side)
        join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)])
        return join(keys, np.uint64), join(owners, np.int64), join(sides, np.int64)

    def left(self) -> np.ndarray:
        """Sets whose cells were not all emptied."""
        return ((self.count != 0) | (self.xor != 0)).reshape(-1, self.cells).any(1)


def _chars(keys: np.ndarray) -> int:
    return int((keys & np.uint64(_LENGTH)).sum())


def differing_chars(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Characters in paragraphs that only one of each pair of digest sets has, by
    subtracting and peeling sketches: first of the size of the smaller
    fingerprint of the two, twice as large again where that fails."""
    out = np.zeros(len(first), np.int64)
    size = np.array([min(cells_for(len(a)), cells_for(len(b))) for a, b in zip(first, second, strict=True)], np.int64)
    # a difference is no smaller than that of the numbers, which no sketch below it can decode
    least = np.array([abs(len(a) - len(b)) for a, b in zip(first, second, strict=True)], np.int64)
    while (size * 4 < least * 5).any():
        size[size * 4 < least * 5] *= 2
    todo = np.arange(len(first))
    while len(todo):
        cells = int(size[todo].min())
        now = todo[size[todo] == cells]
        sketch = Sketches([first[i] for i in now], cells).subtract(Sketches([second[i] for i in now], cells))
        keys, owner, _ = sketch.peel()
        length = np.bincount(owner, (keys & np.uint64(_LENGTH)).astype(np.float64), len(now)).astype(np.int64)
        done = ~sketch.left()
        out[now[done]] = length[done]
        size[now] *= 2
        todo = np.setdiff1d(todo, now[done], assume_unique=True)
    return out


def _like(total, differ):
    """Share of the characters of both sides' paragraphs that both have."""
    both = (total - differ) / 2
    return np.where(total > 0, both / np.maximum(both + differ, 1), 1.0)


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    """Each sketch as text: number of paragraphs, characters in them, cells in base64."""
    out: list[str] = [""] * len(sets)
    size = np.array([cells_for(len(s)) for s in sets], np.int64)
    for cells in np.unique(size).tolist():
        own = np.flatnonzero(size == cells)
        s = Sketches([sets[i] for i in own], cells)
        raw = np.concatenate([s.count.reshape(-1, cells).astype("<i4").view(np.uint8), s.xor.reshape(-1, cells).astype("<u8").view(np.uint8),
                              s.check.reshape(-1, cells).astype("<u4").view(np.uint8)], axis=1)
        for i, r in zip(own.tolist(), raw, strict=True):
            out[i] = f"{len(sets[i])}:{_chars(sets[i])}:" + base64.b64encode(r.tobytes()).decode()
    return out


def _parsed(fingerprint: str, cells: int | None = None):
    """(paragraphs, characters, count, xor, check) folded to ``cells``."""
    n, chars, data = fingerprint.split(":")
    raw = base64.b64decode(data)
    own = len(raw) // _CELL_BYTES
    count, xor, check = (np.frombuffer(raw[a * own:b * own], kind).astype(to) for a, b, kind, to in (
        (0, 4, "<i4", np.int64), (4, 12, "<u8", np.uint64), (12, 16, "<u4", np.uint64)))
    while cells is not None and own > cells:
        half = [x.reshape(PARTS, 2, -1) for x in (count, xor, check)]
        count, xor, check = (half[0].sum(1).ravel(), *((x[:, 0] ^ x[:, 1]).ravel() for x in half[1:]))
        own //= 2
    return int(n), int(chars), count, xor, check


def compare(first: str, second: str) -> float | None:
    """Likeness of two stored fingerprints, or None if they differ in more
    paragraphs than the smaller one can decode (ask for larger ones)."""
    cells = min(len(_parsed(f)[2]) for f in (first, second))
    n1, chars1, *a = _parsed(first, cells)
    n2, chars2, *b = _parsed(second, cells)
    sketch = Sketches([np.zeros(0, np.uint64)], cells)
    sketch.count, sketch.xor, sketch.check = a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]
    keys, _, _ = sketch.peel()
    return None if sketch.left().any() else float(_like(chars1 + chars2, _chars(keys)))


def likeness(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of the paragraphs, weighted by length (1 for two
    texts without): ``compare`` of the fingerprints, with larger sketches of the
    digests wherever that fails."""
    total = np.array([_chars(a) + _chars(b) for a, b in zip(first, second, strict=True)], np.int64)
    return _like(total, differing_chars(first, second))


def spliced(text: str, after: str) -> str:
    """``text`` with its last half replaced by as many of ``after``'s first characters."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


class _Versions:
    """Rows of consecutive documents, compared in batches."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, doc_id, text: str, parts: np.ndarray, after: str, after_parts: np.ndarray) -> None:
        edited = spliced(text, after)
        self.rows.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                          parts, digests(paragraphs(edited)), after_parts))
        self.held += len(text)

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        doc_id, n_chars, sha, own, edited, after = map(list, zip(*self.rows, strict=True))
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), pa.array(n_chars, pa.int64()), pa.array(sha), pa.array(fingerprints(own)),
             pa.array(fingerprints(edited)), pa.array(likeness(own, edited)), pa.array(likeness(own, after))], schema=schema)


VERSIONS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by _part and place, every part closed by its neighbour's
    first row (_extra), which gives no row of its own."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    todo, last = _Versions(), None
    for b in batches:
        for part, doc_id, text, extra in zip(*(b.column(c).to_pylist() for c in ("_part", "doc_id", "text", "_extra")), strict=True):
            keys = digests(paragraphs(text))
            if last and last[0] == part and not last[4]:
                todo.add(last[1], last[2], last[3], text, keys)
                if todo.held > 1 << 21 or len(todo.rows) >= 512:
                    yield todo.take(schema)
            last = (part, doc_id, text, keys, extra)
    if todo.rows:
        yield todo.take(schema)


def _ranges(base: DataFrame, parts: int) -> DataFrame:
    """``base`` with _part: ranges by descending doc_id, null last. An id (or
    null) with more rows than a range should have is a range of its own, cut by
    the hash ``_h`` of its texts into as many as it needs."""
    total = base.count()
    target = max(1, -(-total // parts))
    heavy = {r["doc_id"]: r["count"] for r in base.groupBy("doc_id").count().where(F.col("count") > target).collect()}    # fewer than parts
    bounds = base.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    ids = [i for i in heavy if i is not None]
    starts = np.array(sorted({*map(int, bounds), *ids, *(i + 1 for i in ids if i < 2 ** 63 - 1)}), np.int64)
    n = len(starts)
    # by descending id: place 0 has the ids from the last start on, place n those below the first, n + 1 the null ids
    cuts = np.ones(n + 2, np.int64)
    for i, count in heavy.items():
        cuts[n + 1 if i is None else n - np.searchsorted(starts, i, "right")] = -(-count // target)
    at = np.cumsum(cuts) - cuts

    @F.arrow_udf("int")
    def part(doc_id: pa.Array, h: pa.Array) -> pa.Array:
        place = np.where(doc_id.is_null().to_numpy(zero_copy_only=False), n + 1,
                         n - np.searchsorted(starts, doc_id.fill_null(0).to_numpy(zero_copy_only=False), "right"))
        high = h.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) >> np.uint64(33)
        return pa.array((at[place] + (high.astype(np.int64) * cuts[place] >> 31)).astype(np.int32))

    return base.withColumn("_part", part("doc_id", "_h"))


def fingerprint_versions(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint each text, an edited version of it and their likeness.

    ``docs`` has doc_id (integer) and text (null: empty); other columns are
    ignored. The next document is that of the next smaller doc_id, after the
    last the first; the edited text is ``spliced(text, next text)``. A null
    doc_id comes after all others; rows with one doc_id (or none) follow each
    other by a hash of the text; a single row is its own next; an empty table
    gives an empty result.

    Ids are cut into about ``parts`` ranges (by default twice the shuffle
    partitions), an id with many rows into several, and each range gets its
    neighbour's first document besides, so that no window spans the table.
    """
    spark = docs.sparkSession
    importable(spark)
    parts = parts or max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = base.withColumn("_h", F.xxhash64(F.lit(23), "text"))
    placed = _ranges(hashed, parts)
    # the place of a row within its range, as ``shiftrightunsigned`` orders the hash
    place = F.struct(F.col("doc_id").isNull().alias("no"), F.bitwise_not("doc_id").alias("id"), F.shiftrightunsigned("_h", 1).alias("h"), F.col("_h").alias("low"))
    first = {r["_part"]: r["first"] for r in placed.groupBy("_part").agg(F.min(place).alias("first")).collect()}
    order = sorted(first)                                    # one entry per range
    # a part's first row also closes the part before it, that of the first part the last one
    closes = spark.createDataFrame([(p, None if first[p]["id"] is None else ~first[p]["id"], first[p]["low"], order[i - 1])
                                    for i, p in enumerate(order)], "_p int, _first long, _first_h long, _closes int")
    is_first = F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("_h") == F.col("_first_h"))
    doubled = (placed.join(F.broadcast(closes), F.col("_part") == F.col("_p"))      # a row per range
               .withColumn("_to", F.explode(F.filter(F.array(
                   F.struct(F.col("_part").alias("part"), F.lit(False).alias("extra")),
                   F.struct(F.when(is_first, F.col("_closes")).alias("part"), F.lit(True).alias("extra"))),
                   lambda x: x["part"].isNotNull()))))
    rows = doubled.select(F.col("_to.part").alias("_part"), "doc_id", "text", "_h", F.col("_to.extra").alias("_extra"))
    dealt = rows.repartition(max(1, len(order)), "_part").sortWithinPartitions(
        "_part", "_extra", F.col("doc_id").desc_nulls_last(), F.shiftrightunsigned("_h", 1), "_h", "text")
    return dealt.mapInArrow(_versions, VERSIONS)
