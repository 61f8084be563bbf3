"""A third of the rows under one id and a third under none: bounded collects,
equal reruns, nothing lost."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil.llm import line_dedup, mixing, packing, queries, topk, toxicity, warc
from vigil.session import shared_dir

DOCS = "doc_id long, text string, lang string, source string"
WORDS = [f"w{i}" for i in range(300)]
SF = "/root/testdata/sf0.001"


def hot_rows(n=600, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(r.choices(WORDS, k=r.randint(0, 40)))
        if i % 4 == 0:
            text += "\nA passage that many of the documents hold\n" + r.choice(WORDS)
        rows.append((7 if i % 3 == 0 else None if i % 3 == 1 else 1000 + i, text, r.choice(["en", "de"]), r.choice("ab")))
    return rows + [(7, "same text", "en", "a")] * 20 + [(None, None, "en", "a")] * 20


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), DOCS)


def both(df, run):
    """The result under 3 and under 7 partitions, as sorted texts."""
    out = [sorted(str(tuple(r)) for r in run(df.repartition(n)).collect()) for n in (3, 7)]
    assert out[0] == out[1]
    return out[0]


def test_topk_of_repeated_ids(spark):
    v = lambda *x: [float(i) for i in x]
    rows = [(0, v(1, 0)), (1, v(1, 0)), (1, v(0.5, 0)), (1, v(0.5, 0)), (50, v(0, 1)), (50, v(1, 1)), (2, v(1e19, 0)), (3, v(3e9, 1)), (4, v(1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.whole_vectors(df)
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 1, 1, 4, 50, 50]
    got = both(df, lambda d: topk.search(topk.whole_vectors(d), F.col("vec_id") % 50 == 0, k=5, sample_rows=4, cells=2))
    whole = sorted({(i, tuple(int(256 * x) for x in e)) for i, e in rows if max(e) < 1e6})
    want = []
    for q, x in whole:
        if q % 50 == 0:
            dots = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if (i, y) != (q, x))[:5]
            want += [str((q, k + 1, i, -s)) for k, (s, i) in enumerate(dots)]
    assert got == sorted(want)


def test_line_dedup_of_hot_ids(spark, hot):
    want = []
    rows = hot_rows()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for i, (d, text, *_) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(d)
    keep = {k: max((d for d in ids if d is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    for d, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in keep or keep[key(x)] is None or keep[key(x)] == d]
        want.append(str((d, len(lines), len(lines) - len(stay), "\n".join(stay))))
    for probes in (250_000, 40, 7):                        # shards are copied where a key has more probes
        for heavy in (1024, 2):
            got = both(hot, lambda d: line_dedup.dedup_lines(d, heavy_parts=heavy, probes_per_shard=probes).select(
                "doc_id", "n_lines", "n_dropped", "kept_text"))
            assert got == sorted(want)


def test_mixing_of_hot_ids(hot):
    got = both(hot, lambda d: mixing.mix_documents(d, shard_words=200).select("doc_id", "size", "source", "target", "taken"))
    texts = both(hot, lambda d: mixing.mixed_texts(d, shard_words=200).select("doc_id", "text"))
    assert len(got) == 640 and texts
    one = both(hot.sparkSession.createDataFrame([(5, f"text {i:05d}", "en", "a") for i in range(2000)], DOCS),
               lambda d: mixing.mixed_texts(d, total_share=0.5))
    assert 400 < len(one) < 1100
    dealt = mixing.mix(mixing.with_sizes(hot), shard_words=200)
    plan = dealt._jdf.queryExecution().toString()
    assert "xxhash64" in plan


def test_taken_is_what_the_mix_holds(spark, hot):
    """``taken`` of every row against the words of its texts in the mix."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    unique = spark.createDataFrame([(i, t, lang, s) for i, (_, t, lang, s) in enumerate(hot_rows(300, 5))], DOCS)
    taken = {r.doc_id: r for r in mixing.mix_documents(unique, shard_words=300).collect()}
    found = dict.fromkeys(taken, 0)
    for r in mixing.mixed_texts(unique, shard_words=300).collect():
        found[r.doc_id] += words(r.text)
    assert found == {i: r.taken for i, r in taken.items()}
    for r in taken.values():
        assert r.size == words(next(t for i, (_, t, *_) in enumerate(hot_rows(300, 5)) if i == r.doc_id)) and r.taken <= 2 * r.size
    for s in "ab":
        own = [r for r in taken.values() if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 16 + 0.05 * own[0].target and own[0].source_size == sum(r.size for r in own)


def test_toxicity_learns_from_bounded_rows(spark, monkeypatch):
    r = random.Random(3)
    docs = [(7, f"nice {' '.join(r.choices(WORDS, k=5))}") for _ in range(3000)] + [(None, "x")] * 3000
    docs += [(100 + i, ("idiot " if i % 2 else "kind ") + " ".join(r.choices(WORDS, k=8))) for i in range(400)]
    labels = [(7, 0)] * 500 + [(None, 1)] * 500 + [(100 + i, i % 2) for i in range(400)] + [(100, None), (101, 7), (99, 1)]
    df = spark.createDataFrame([(*d, 0.5, "a") for d in docs], "doc_id long, text string, score double, source string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    sizes = []
    fit = toxicity.FactorizationMachine.fit.__func__
    monkeypatch.setattr(toxicity.FactorizationMachine, "fit", classmethod(
        lambda cls, texts, *a, **b: sizes.append(len(texts)) or fit(cls, texts, *a, **b)))
    models = [toxicity.train(df.repartition(n), known.repartition(n), rows_per_class=50) for n in (3, 7)]
    assert all(n <= 100 for n in sizes)                    # ids, however often they come
    assert (models[0].weight == models[1].weight).all() and (models[0].vector == models[1].vector).all()
    scored = toxicity.score(df, models[0]).select("doc_id", "text", "score").collect()
    assert len(scored) == len(docs)
    assert np.mean([(x.score > 0.5) == x.text.startswith("idiot") for x in scored if (x.doc_id or 0) >= 100]) > 0.97


def test_pair_sums_and_their_gradient_equal_double_loops():
    r = np.random.default_rng(0)
    slots = np.array([2, 5, 9, 11])
    m = toxicity.FactorizationMachine(slots, 0.3, r.normal(size=4), r.normal(size=(4, 3)))
    texts = [np.array([2, 5, 9]), np.array([], np.int64), np.array([3, 5]), np.array([2, 5, 9, 11, 40])]
    at, starts = m.rows(texts)
    z, _ = m.logits(at, starts)

    def plain(v, text):
        own = [int(np.searchsorted(slots, s)) for s in text if s in slots]
        pairs = sum(float(v[i] @ v[j]) for k, i in enumerate(own) for j in own[k + 1:])
        return 0.3 + sum(m.weight[i] for i in own) + pairs
    assert np.allclose(z, [plain(m.vector, t) for t in texts])
    # one step of the vectors against numeric derivatives of the loss
    label, weight = np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 0.5])

    def loss(v):
        s = np.array([plain(v, t) for t in texts])
        return float((weight * (np.log1p(np.exp(-np.abs(s))) + np.maximum(s, 0) - label * s)).sum() / len(texts))
    own = toxicity.FactorizationMachine(slots, 0.3, m.weight, m.vector.copy())

    class Still:
        """Starts from the given vectors, in the given order."""
        def normal(self, *_):
            return m.vector.copy()

        def permutation(self, n):
            return np.arange(n)
    own._fit_vectors(at, starts, label, weight, 1, 4, 1e-4, 0.0, Still())
    grad = np.zeros_like(m.vector)
    for i in np.ndindex(grad.shape):
        step = np.zeros_like(grad)
        step[i] = 1e-5
        grad[i] = (loss(m.vector + step) - loss(m.vector - step)) / 2e-5
    assert np.allclose(own.vector - m.vector, -1e-4 * grad / np.sqrt(1e-3 + grad * grad), atol=1e-9)


def test_warc_has_one_response_for_a_repeated_largest_id(spark):
    rows = [(9, "u2", "same"), (9, "u1", "same"), (9, "u1", "same"), (3, "u", "same"), (None, "u", "same"), (4, None, "x"), (4, "v", "x"),
            (None, "n", "only"), (None, "n", "only"), (5, "e", None), (6, "e", "")]
    df = spark.createDataFrame([(*x, "p") for x in rows], "page_id long, url string, html string, payload string")
    root = shared_dir(spark, "warc")
    back = warc.read_records(warc.write_pages(df.repartition(4), root), root).collect()
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in back)
    assert kinds == sorted([("9", "response", "None"), ("9", "revisit", "9"), ("9", "revisit", "9"), ("3", "revisit", "9"), ("None", "revisit", "9"),
                            ("4", "response", "None"), ("4", "revisit", "4"), ("None", "response", "None"), ("None", "response", "None"),
                            ("6", "response", "None"), ("5", "revisit", "6")])


def test_packing_of_very_many_empty_texts():
    packer = packing.Packer(2048, 4.0, 24.0, np.zeros(10, bool))
    one = np.array([1], "<u4")
    for i in range(1 << 18):
        packer.add(i, one)
    began = time.perf_counter()
    first = packer.take(False)
    rest = packer.take(True)
    assert time.perf_counter() - began < 30
    assert sum(first["length"]) + sum(rest["length"]) == 1 << 18
    assert first["doc_id"] + rest["doc_id"] == list(range(1 << 18))


def test_packing_of_hot_ids(spark, hot):
    import public_tokenizers
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(hot.repartition(3), path, size=64, with_ids=False).collect()
    tokens = {}
    for r in got:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    again = packing.pack(hot.repartition(7), path, size=64, with_ids=False).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert tokens == {r.doc_id: r.n for r in again}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_returns_its_contract(spark, name):
    """Columns and row numbers of each registered query on a small folder."""
    columns = {"op1_topk": "query_id rank vec_id score", "op3_fingerprint": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
               "op4_language": "doc_id held_out lang_pred score", "op5_line_dedup": "doc_id n_lines n_dropped kept_sha256",
               "op6_mixing": "doc_id size source_size target taken", "op7_toxicity": "doc_id held_out score predicted",
               "op8_near_dup": "doc_id n_shingles component_id", "op9_warc": "page_id payload_bytes payload_digest record_type refers_to",
               "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op2_chat": "conv_id n_turns copies text",
               "op11_centroids": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
               "op12_embedding_dedup": "vec_id n_links component_id kept",
               "op13_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"}[name].split()
    kinds = {"rank": "int", "predicted": "int", "cluster": "int", "held_out": "boolean", "kept": "boolean", "score": "bigint" if name == "op1_topk" else "double",
             "near_edited": "double", "near_next": "double", "target": "double", "record_type": "string", "payload_digest": "string",
             "lang_pred": "string", "fingerprint": "string", "edited_fingerprint": "string", "text": "string"}
    df = queries.queries()[name](spark, SF)
    got = dict(df.dtypes)
    for c in columns:
        assert got[c] == kinds.get(c, "string" if c.endswith("sha256") else "bigint"), c
    rows = df.collect()
    if name in ("op3_fingerprint", "op4_language", "op5_line_dedup", "op6_mixing", "op7_toxicity", "op8_near_dup"):
        ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
    if "held_out" in columns:
        import zlib
        of, rest = (4, 2) if name == "op4_language" else (5, 0)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == rest) for r in rows)
    assert rows
