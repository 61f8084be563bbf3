"""N-gram Jaccard join by prefixes and token combinations.

Texts are sets of word shingles. All sets are ordered alike, rare shingles
first by a fixed-size table of counts over the whole corpus. Two linked sets
share at least two shingles among the first |x| - least overlap + 2 of each, so:

* a shingle that few prefixes hold (rare class) is indexed alone: the sets of
  such a list are compared by exact bounds (sizes, positions, bit parity);
* a list of more than ``rare_most`` sets (frequent class) is dealt into blocks
  compared in the same way, and sets of different blocks that are not yet
  connected meet by the combinations of two frequent shingles they share.

Both give a graph that holds every link and little else. Its components are
small; each set is sent once to its component's task and verified there. A large
component is dealt into blocks: sets are verified within their block, then one
set of each group found is verified against those of the other blocks, and only
components that are still in several groups are verified block against block.
Equal sets are one class throughout, copies are never paired.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed_width, importable, mix64, seeded64, written
from vigil.llm.components import components

CELL_BITS = (20, 24)              # of the table of shingle counts: grows with the documents between these
FILTER_BITS = (25, 28)            # of the filter before texts are shuffled: with the members
BITS = 512                        # of a set's parity sketch
_EXTEND = 2                       # shared prefix shingles of a linked pair
_BLOCK = 1 << 22                  # bytes of text hashed at once


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the number of words in each text, for texts that
    lie in ``data`` between ``offsets``."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = ~white
    start[1:] &= white[:-1] | cut[1:len(data)]
    at = np.flatnonzero(start)
    words = np.searchsorted(at, offsets[1:]) - np.searchsorted(at, offsets[:-1])
    if not len(at):
        return np.zeros(0, np.uint64), words
    low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    value = seeded64(np.arange(256, dtype=np.uint64), 1)
    value[[32, 9, 10, 11, 12, 13]] = 0
    place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data)))) if at[0] == 0 else np.concatenate(
        [np.zeros(at[0], np.int64), np.arange(at[0], len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))])
    place[white] = 0
    factor = seeded64(np.arange(int(place.max()) + 1, dtype=np.uint64), 2) | np.uint64(1)
    return mix64(np.add.reduceat(value[low] * factor[place], at)), words


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space."""
    start = 0
    while len(raw) - start > _BLOCK:
        end = min((p for p in (raw.find(c, start + _BLOCK) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0), default=len(raw))
        yield raw[start:end]
        start = end
    yield raw[start:]


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``width`` words each, A-Z
    lower-cased; with fewer words the whole sequence is one; none without words."""
    with np.errstate(over="ignore"):
        factors = seeded64(np.arange(width, dtype=np.uint64), 3) | np.uint64(1)
        held: list[bytes] = []
        parts: list[int] = []                     # number of pieces of each text
        size = 0

        def flush() -> Iterator[np.ndarray]:
            offsets = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int64)
            words, counts = _word_hashes(np.frombuffer(b"".join(held), np.uint8), offsets)
            ends = np.cumsum(np.add.reduceat(counts, np.cumsum([0, *parts[:-1]]))) if parts else []
            n = len(words) - width + 1
            full = np.zeros(max(n, 0), np.uint64)
            for i in range(width):
                full += words[i:i + max(n, 0)] * factors[i]
            full = mix64(full + np.uint64(width))
            begin = 0
            for end in ends:
                count = int(end) - begin
                if count >= width:
                    yield np.unique(full[begin:int(end) - width + 1])
                elif count:
                    whole = (words[begin:int(end)] * factors[:count]).sum(dtype=np.uint64)
                    yield mix64(np.array([whole + np.uint64(count)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
                begin = int(end)

        for text in texts:
            own = list(_pieces((text or "").encode()))
            held += own
            parts.append(len(own))
            size += sum(map(len, own))
            if size >= _BLOCK:
                yield from flush()
                held, parts, size = [], [], 0
        if parts:
            yield from flush()


def least_overlap(a, b, percent: int):
    """Fewest shared shingles of two linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _bits_for(rows: int, bounds: tuple[int, int]) -> int:
    return min(max(int(rows).bit_length(), bounds[0]), bounds[1])


def _cell(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> np.uint64(64 - bits)).astype(np.int64)


def _cells(width: int, bits: int):
    """Per partition: how many sets have a shingle of each cell, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for b in batches:
            for s in shingle_sets(b.column("text").to_pylist(), width):
                np.add.at(total, _cell(s, bits), np.uint32(1))
        blocks = [(i, zlib.compress(part.tobytes(), 1)) for i, part in enumerate(np.split(total, 64)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([z for _, z in blocks], pa.binary())],
                                         ["block", "counts"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, z in zip(b.column("block").to_pylist(), b.column("counts").to_pylist(), strict=True):
            total[i] = total.get(i, 0) + np.frombuffer(zlib.decompress(z), np.uint32).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(t, 2 ** 32 - 1).astype("<u4").tobytes() for t in total.values()], pa.binary())],
                                     ["block", "counts"])


def shingle_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Counts over all documents, by cell: a cell or more per document, up to a
    table of 64 MB. More shingles a cell only make the order less sharp."""
    bits = _bits_for(docs.count(), CELL_BITS)
    parts = docs.select("text").mapInArrow(_cells(width, bits), "block int, counts binary")
    rows = parts.repartition(64, "block").mapInArrow(_added, "block int, counts binary").collect()   # 64 rows
    out = np.zeros((64, (1 << bits) // 64), np.uint32)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["counts"], "<u4")
    return out.ravel()


def _filter_places(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for seed in range(3):
        yield (seeded64(ids.astype(np.int64).view(np.uint64), 40 + seed) >> np.uint64(64 - bits)).astype(np.int64)


def _filter_parts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << width, bool)
        for b in batches:
            for at in _filter_places(b.column("cid").to_numpy(), width):
                bits[at] = True
        blocks = [(i, zlib.compress(np.packbits(part).tobytes(), 1)) for i, part in enumerate(np.split(bits, 64)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([z for _, z in blocks], pa.binary())],
                                         ["block", "bits"])
    return run


def _filter_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, z in zip(b.column("block").to_pylist(), b.column("bits").to_pylist(), strict=True):
            total[i] = total.get(i, 0) | np.frombuffer(zlib.decompress(z), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                     ["block", "bits"])


def maybe_member(ids: DataFrame):
    """Column function: false only for a doc_id that is null or not among ``ids``
    (cid). A Bloom filter that grows with the ids up to 32 MB; beyond that more
    of the others pass it, so an exact join follows."""
    width = _bits_for(ids.count() * 8, FILTER_BITS)
    rows = (ids.mapInArrow(_filter_parts(width), "block int, bits binary").repartition(64, "block")
            .mapInArrow(_filter_joined, "block int, bits binary").collect())         # 64 rows
    packed = np.zeros((64, (1 << width) // 512), np.uint8)
    for r in rows:
        packed[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    packed = packed.ravel()

    @F.arrow_udf("boolean")
    def check(doc_id: pa.Array) -> pa.Array:                             # whole 64 bits beside nulls, too
        ok = doc_id.is_valid().to_numpy(zero_copy_only=False).copy()
        for at in _filter_places(doc_id.fill_null(0).to_numpy(zero_copy_only=False), width):
            ok &= (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return pa.array(ok)

    return check


def _parity(s: np.ndarray) -> bytes:
    return np.packbits(np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8).tobytes()


def _profiles(width: int, percent: int, counts: np.ndarray):
    """Per document: size, identity and prefix of its set, and the parity sketch."""
    bits_of_cell = len(counts).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                n, s1, s2, bits, prefix = [], [], [], [], []
                for s in shingle_sets(b.column("text").to_pylist(), width):
                    n.append(len(s))
                    s1.append(s.sum(dtype=np.uint64))
                    s2.append(seeded64(s, 5).sum(dtype=np.uint64))
                    bits.append(_parity(s))
                    order = np.argsort(counts[_cell(s, bits_of_cell)], kind="stable")   # then by hash
                    prefix.append(s[order[:len(s) - -(-percent * len(s) // 100) + _EXTEND]])
                flat = np.concatenate([*prefix, np.zeros(0, np.uint64)]).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)),
                     pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(bits, pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
                    ["doc_id", "n", "s1", "s2", "bits", "prefix"])
    return run


def _near(n, pos, bits, i, j, percent: int) -> np.ndarray:
    """Whether rows i and j, lists of one shingle, may be linked: the sizes
    allow it, the shingles left after this one (the first or second that both
    share) are enough, and the parities don't differ in too many bits."""
    a, b = n[i], n[j]
    need = least_overlap(a, b, percent)
    ok = (np.minimum(a, b) >= need) & (_EXTEND + np.minimum(a - pos[i], b - pos[j]) - 1 >= need)
    return ok & (np.bitwise_count(bits[i] ^ bits[j]).sum(-1) <= a + b - 2 * need)


def _forest(rows: tuple, percent: int) -> list[tuple[int, int]]:
    """Edges that connect whatever may be linked in one list."""
    cid, n, pos, bits = rows
    left, edges = np.arange(len(cid)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        root = queue[0]
        while queue and len(left):
            i = queue.pop()
            near = _near(n, pos, bits, i, left, percent)
            found, left = left[near], left[~near]
            edges += [(int(cid[root]), int(cid[j])) for j in found]
            queue += found.tolist()
    return edges


def _lists(percent: int):
    """Rows sorted by (tok, block): candidate edges of each list."""
    def work(t: pa.Table) -> pa.RecordBatch:
        tok, block, cid, n, pos = (t[c].to_numpy() for c in ("tok", "block", "cid", "n", "pos"))
        bits = fixed_width(t["bits"], BITS // 8).view(np.uint64)
        new = np.concatenate([[True], (tok[1:] != tok[:-1]) | (block[1:] != block[:-1])])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(tok)))
        two = start[size == 2]
        near = two[_near(n, pos, bits, two, two + 1, percent)]
        a, b = [cid[near]], [cid[near + 1]]
        for s, k in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = slice(s, s + k)
            if edges := _forest((cid[own], n[own], pos[own], bits[own]), percent):
                x = np.array(edges, np.int64)
                a.append(x[:, 0])
                b.append(x[:, 1])
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                continue
            tok, block = t["tok"].to_numpy(), t["block"].to_numpy()
            last = int(np.flatnonzero((tok != tok[-1]) | (block != block[-1])).max(initial=-1)) + 1
            if last:
                yield work(t.slice(0, last).combine_chunks())
            held = t.slice(last)
        if held is not None and held.num_rows:
            yield work(held.combine_chunks())
    return run


def shared_counts(sets: list[np.ndarray], columns: int = 1 << 13) -> np.ndarray:
    """(sets, sets) numbers of shared shingles, above the diagonal: the shingles
    that at least two sets have as rows of bits, ``columns`` at a time."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    same = flat[1:] == flat[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    flat, owner = flat[keep], owner[keep]
    column = np.cumsum(np.concatenate([[False], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    out = np.zeros((len(sets), len(sets)), np.int32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(column, [first, first + columns]))
        rows, at = np.unique(owner[part], return_inverse=True)
        bits = np.zeros((len(rows), columns), bool)
        bits[at, column[part] - first] = True
        bits = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(len(rows) - 1):
            out[rows[i], rows[i + 1:]] += np.bitwise_count(bits[i + 1:] & bits[i]).sum(1, dtype=np.int32)
    return out


def _verified(width: int, percent: int):
    """Exact links among the texts of one part of a component, as edges to the
    least member of each connected group."""
    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t["cid"].to_numpy(), kind="stable")
        cid = t["cid"].to_numpy()[order]
        sets = list(shingle_sets(t["text"].take(pa.array(order)).to_pylist(), width))
        n = np.array([len(s) for s in sets], np.int64)
        shared = shared_counts(sets)
        shared += shared.T
        left, a, b = np.arange(len(cid)), [], []
        while len(left) > 1:
            queue, left, root = [left[0]], left[1:], left[0]
            while queue and len(left):
                i = queue.pop()
                near = 100 * shared[i, left].astype(np.int64) >= percent * (n[left] + n[i] - shared[i, left])
                found, left = left[near], left[~near]
                a += [int(cid[root])] * len(found)
                b += cid[found].tolist()
                queue += found.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _dealt(nodes: DataFrame, block_most: int, block_shingles: int) -> DataFrame:
    """(node, component, own, parts): the sets of each component dealt into
    blocks of about ``block_most`` sets and ``block_shingles`` shingles."""
    sizes = written(nodes.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(block_most)), F.ceil(F.sum("n") / F.lit(block_shingles))).cast("int").alias("parts")), "component-sizes")
    return nodes.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _verify(base: DataFrame, members: DataFrame, check, width: int, percent: int) -> DataFrame:
    """Exact links (a, b) among the ``members`` (cid, component, lo, hi) of each
    part, from the texts of those that ``check`` lets pass."""
    texts = base.where(check("doc_id")).alias("d").join(members.alias("m"), F.col("d.doc_id") == F.col("m.cid")).select(
        "component", "lo", "hi", "cid", "text")
    return texts.groupBy("component", "lo", "hi").applyInArrow(_verified(width, percent), "a long, b long")


def _block_pairs(dealt: DataFrame) -> DataFrame:
    """Members of every pair of different blocks of their component."""
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: i != F.col("own")))
    return dealt.where(F.col("parts") > 1).withColumn("other", other).select(
        F.col("node").alias("cid"), "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def verified_links(base: DataFrame, labels: DataFrame, classes: DataFrame, width: int, percent: int, block_most: int,
                   block_shingles: int) -> DataFrame:
    """Exact links (a, b) among the texts of each component of ``labels`` (node,
    component): enough of them to connect whatever is connected."""
    sizes = classes.groupBy("cid").agg(F.sum("n").alias("n"))
    nodes = written(labels.join(sizes, F.col("node") == F.col("cid")).select("node", "component", "n"), "component-members")
    check = maybe_member(nodes.select(F.col("node").alias("cid")))          # so that other texts are not shuffled
    dealt = written(_dealt(nodes, block_most, block_shingles), "component-blocks")
    within = dealt.select(F.col("node").alias("cid"), "component", F.col("own").alias("lo"), F.col("own").alias("hi"))
    links = written(_verify(base, within, check, width, percent), "links-within")
    large = dealt.where(F.col("parts") > 1)
    if large.isEmpty():
        return links

    # one set of each group found so far, against those of the other groups
    def grouped(found: DataFrame) -> DataFrame:
        """The sets of large components with their group."""
        groups = components(found)
        return written(large.select("node", "component", "n", "own", "parts").join(groups.withColumnRenamed("component", "g"), "node", "left")
                       .withColumn("g", F.coalesce("g", "node")), "component-groups")

    first = grouped(links.join(large.select(F.col("node").alias("a")), "a", "left_semi"))
    chosen = _dealt(first.where(F.col("node") == F.col("g")).select("node", "component", "n"), block_most, block_shingles)
    chosen = written(chosen, "group-blocks")
    among = chosen.select(F.col("node").alias("cid"), "component", F.col("own").alias("lo"), F.col("own").alias("hi"))
    links = written(links.union(_verify(base, among.union(_block_pairs(chosen)), check, width, percent)), "links-between")

    # components that are still in several groups: every block against every other
    second = grouped(links.join(large.select(F.col("node").alias("a")), "a", "left_semi"))
    several = second.groupBy("component").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where(F.col("lo") < F.col("hi")).select("component")
    several = written(several, "open-components")
    if several.isEmpty():
        return links
    rest = _block_pairs(second.join(several, "component", "left_semi"))
    return written(links.union(_verify(base, rest, check, width, percent)), "links-all")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, rare_most: int = 2048, block_most: int = 2048,
                    block_shingles: int = 1 << 21) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id
    integer, text; other columns are ignored).

    Two texts link if ``100 * shared shingles >= percent * all shingles``
    (``percent`` over 50); component_id is the smallest doc_id that links
    reach, itself included. Null, empty and white texts have no shingle and no
    link. Rows with a null doc_id link with nothing and have a null
    component_id; rows of one doc_id are one document; repeated rows are
    returned as often as they come; an empty table gives an empty result.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50, as linked sets must share two shingles or be equal")
    importable(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = shingle_counts(base, width)
    profiles = written(base.mapInArrow(_profiles(width, percent, counts),
                                       "doc_id long, n long, s1 long, s2 long, bits binary, prefix array<long>"), "shingle-profiles")
    named = profiles.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = written(named.groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("cid"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix")), "shingle-classes")

    # lists of a shingle, without those that only one class has: counted map-side,
    # so that the join may split a list that many sets are in
    # ``s1`` stands for the class in them (were two alike, both would be compared)
    held = classes.select("s1", "n", F.posexplode("prefix").alias("pos", "tok"))
    several = held.groupBy("tok").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    lists = written(held.join(several, "tok"), "shingle-lists")
    dealt = (lists.withColumn("block", F.pmod(F.xxhash64("s1", "tok"), F.ceil(F.col("size") / F.lit(rare_most))).cast("int"))
             .join(classes.select("s1", "cid", "bits"), "s1").select("tok", "block", "cid", "n", "pos", "bits"))
    edges = (dealt.repartition("tok", "block").sortWithinPartitions("tok", "block", "n")
             .mapInArrow(_lists(percent), "a long, b long"))
    labels = components(edges)
    frequent = lists.where(F.col("size") > rare_most)
    if not frequent.isEmpty():
        labels = _joined_by_pairs(frequent.select("tok", "s1").join(classes.select("s1", "cid"), "s1"), labels)
    links = verified_links(base, labels, classes, width, percent, block_most, block_shingles)

    # the classes of one document's rows are linked by it
    ends = [f(c).alias(f"{name}_{c}") for c in ("s1", "s2", "n") for name, f in (("lo", F.min), ("hi", F.max))]
    several = named.groupBy("doc_id").agg(*ends).where("lo_s1 < hi_s1 or lo_s2 < hi_s2 or lo_n < hi_n").select("doc_id")
    held = named.join(several, "doc_id").select("doc_id", "s1", "s2", "n").distinct()
    own = held.join(classes.select("s1", "s2", "n", "cid"), ["s1", "s2", "n"]).select(F.col("doc_id").alias("a"), F.col("cid").alias("b"))
    # and a row without shingles goes with its document's others
    empty = profiles.where((F.col("n") == 0) & F.col("doc_id").isNotNull())
    beside = (named.join(empty.select("doc_id").distinct(), "doc_id").select("doc_id", "s1", "s2", "n").distinct()
              .join(classes.select("s1", "s2", "n", "cid"), ["s1", "s2", "n"]).select(F.col("doc_id").alias("a"), F.col("cid").alias("b")))
    final = components(links.union(own).union(beside))

    of_class = classes.join(final, classes["cid"] == final["node"], "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("n").alias("cn"), F.coalesce("component", "cid").alias("component_id"))
    found = profiles.join(of_class, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn")), "left")
    found = found.where((F.col("n") > 0) | F.col("doc_id").isNull()).select("doc_id", "n", "component_id").union(
        empty.join(final, empty["doc_id"] == final["node"], "left").select("doc_id", "n", F.col("component").alias("component_id")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _joined_by_pairs(frequent: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` with the components joined that share a combination of two
    frequent shingles. Only shingles whose lists still span several components
    matter; whatever else shares one is connected already. The combinations of
    a set are a join of its shingles, however many it has."""
    named = (frequent.join(labels, frequent["cid"] == labels["node"], "left")
             .select("tok", "cid", F.coalesce("component", "cid").alias("component")))
    live = named.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi"))
    of = written(named.join(live.select("tok"), "tok").distinct(), "live-shingles")
    both = (F.col("x.cid") == F.col("y.cid")) & (F.col("x.component") == F.col("y.component")) & (F.col("x.tok") < F.col("y.tok"))
    rows = of.alias("x").join(of.alias("y"), both).select(
        F.col("x.component").alias("component"), F.struct(F.col("x.tok").alias("x"), F.col("y.tok").alias("y")).alias("pair")).distinct()
    star = rows.groupBy("pair").agg(F.min("component").alias("lo"))
    edges = rows.join(star, "pair").where(F.col("component") > F.col("lo")).select(F.col("component").alias("a"), F.col("lo").alias("b"))
    merged = components(edges)
    renamed = labels.join(merged.withColumnRenamed("component", "to").withColumnRenamed("node", "_n"),
                          labels["component"] == F.col("_n"), "left").select("node", F.coalesce("to", "component").alias("component"))
    # a class that was alone until now is its own component
    alone = merged.join(labels, merged["node"] == labels["node"], "left_anti").select("node", "component")
    return written(renamed.union(alone), "joined-components")
