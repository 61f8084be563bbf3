"""Operators of vigil.llm against brute force, round trips and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vigil.llm import chat, fingerprint, language, line_dedup, mixing, near_dup, packing, tokens, topk, toxicity, warc
from vigil.llm.components import components
from vigil.llm.perfect_hash import LineIndex
from vigil.session import shared_dir

TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))
DOCS = "doc_id long, text string, lang string, source string, keys string"
WORDS = [f"w{i}" for i in range(400)]


def words(r, n):
    return " ".join(r.choices(WORDS, k=n))


def odd_docs():
    """Nulls, empty and long texts, ties and repeated rows; ``keys`` clashes with internal names."""
    r = random.Random(3)
    long = "\n".join(words(r, 12) + "." for _ in range(900))
    rows = [(1, None, "en", "a", "k"), (2, "", None, None, None), (3, "  \n\t", "en", "a", None), (4, long, "en", "a", "x"),
            (5, "Same line of some length here\nrest one", "en", "b", ""), (6, "same line of some length here \nrest two", "en", "b", ""),
            (7, "Same line of some length here", "de", None, ""), (7, "Same line of some length here", "de", None, ""),
            (None, "Same line of some length here\nno id", "de", "b", ""), (8, "x" * 5000, "en", "c", ""), (9, "日本語 テキスト", "ja", "c", "")]
    return rows + [(100 + i, words(r, 30 + i), "en" if i % 2 else "de", "ab"[i % 2], "") for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOCS).repartition(3).cache()


def test_topk_matches_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(0, 0.3, (400, 8)).round(2)
    x[50:200] = x[50]                                            # a hot vector
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)] + [(900, None, ""), (950, [float("nan")] * 8, ""), (951, [None] * 8, ""), (None, [1.0] * 8, ""), (0, x[0].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    got = {(h.query_id, h.rank): (h.vec_id, h.score) for h in topk.search(
        topk.whole_vectors(df), F.col("vec_id") % 50 == 0, k=5, sample_rows=40, cells=8, query_group=3, data_block=60).collect()}
    whole = np.floor(256 * x).astype(int)
    want = {}
    for q in range(0, 400, 50):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(400) if i != q)[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert topk.search(topk.whole_vectors(df.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_chat_keeps_maximal(spark):
    t = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (3, 0, "user", "a"), (3, 1, "bot", "b"), (3, 1, "bot", "b"),
         (4, 0, "user", "a"), (4, 1, "bot", None), (5, 0, "user", ""), (None, 0, "user", "z"), (6, None, None, "q")]
    df = spark.createDataFrame([(*x, 1) for x in t], "conv_id long, turn long, role string, text string, n int")
    got = {r.conv_id: (r.n_turns, r.copies, r.text) for r in chat.format_chats(df).collect()}
    assert set(got) == {2, 4, 5, 6} and got[2][:2] == (2, 2)
    assert got[2][2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nb<|im_end|>\n"
    assert chat.format_chats(df.limit(0)).count() == 0


def weighted_jaccard(a, b):
    """Of the multisets of paragraphs, by characters."""
    x, y = (Counter(fingerprint.paragraphs(t)) for t in (a, b))
    size = lambda c: sum(len(p) * n for p, n in c.items())
    return size(x & y) / size(x | y) if size(x | y) else 1.0


def brute_versions(spark, rows):
    """(doc_id, n_chars, edited_sha256, near_edited, near_next) of (doc_id, text) rows."""
    df = spark.createDataFrame([(i, d, t or "") for i, (d, t) in enumerate(rows)], "i int, doc_id long, text string")
    h = {r.i: r.h % 2 ** 64 for r in df.select("i", F.xxhash64(F.lit(23), "text").alias("h")).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), h[i]))
    out = []
    for k, i in enumerate(order):
        a, b = rows[i][1] or "", rows[order[(k + 1) % len(order)]][1] or ""
        half = len(a) // 2
        edited = a[:len(a) - half] + b[:half]
        out.append((rows[i][0], len(a), hashlib.sha256(edited.encode()).hexdigest(), round(weighted_jaccard(a, edited), 9), round(weighted_jaccard(a, b), 9)))
    return sorted(map(str, out))


def found_versions(df, **options):
    return sorted(str((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)))
                  for r in fingerprint.fingerprint_versions(df, **options).collect())


def test_fingerprint_versions(spark, docs):
    want = brute_versions(spark, [d[:2] for d in odd_docs()])
    for parts in (1, 4, 40):
        assert found_versions(docs, parts=parts) == want
    assert fingerprint.fingerprint_versions(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a lone text. It has two sentences")], "doc_id long, text string")
    assert found_versions(one) == brute_versions(spark, [(1, "a lone text. It has two sentences")])


def test_fingerprints_of_hot_ids_are_cut_into_ranges(spark):
    r = random.Random(8)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else r.choice([i, -i, 2 ** 62 + i, -2 ** 63 + i, 2 ** 63 - 1 - i]), words(r, r.randint(0, 60)))
            for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_versions(df, parts=16) == brute_versions(spark, rows)
    base = df.withColumn("_h", F.xxhash64(F.lit(23), "text"))
    sizes = [x["count"] for x in fingerprint._ranges(base, 16).groupBy("_part").count().collect()]
    assert max(sizes) <= 2 * 900 / 16


def test_stored_fingerprints_compare_or_ask_for_larger_ones(spark):
    r = random.Random(4)
    asked = 0
    for n in (0, 1, 5, 40, 300, 2000):
        for _ in range(12):
            a = words(r, n)
            cut = r.randint(0, len(a))
            b = a[:cut] + r.choice(["", words(r, 3), words(r, n)]) + a[min(len(a), cut + r.randint(0, 50)):]
            x, y = (fingerprint.digests(fingerprint.paragraphs(t)) for t in (a, b))
            one, two = fingerprint.fingerprints([x, y])
            got = fingerprint.compare(one, two)
            asked += got is None
            assert got is None or abs(got - weighted_jaccard(a, b)) < 1e-9
            assert fingerprint.compare(one, one) == 1.0
            assert got is not None or weighted_jaccard(a, b) < 0.6     # near versions are told from the stored ones
    assert asked
    a = words(r, 3000)                                                  # an inserted word changes the paragraph around it only
    assert weighted_jaccard(a, a[:100] + " more " + a[100:]) > 0.95
    c = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(3000))   # no spaces at all
    assert weighted_jaccard(c, c[:50] + "X" + c[50:]) > 0.95


def test_peeling_recovers_the_difference():
    r = random.Random(5)
    for n, d in ((0, 0), (10, 1), (300, 40), (50, 500)):
        a = [words(r, 5) for _ in range(n)]
        b = a[n // 3:] + [words(r, 6) for _ in range(d)]
        x, y = fingerprint.digests(a), fingerprint.digests(b)
        want = sum(int(k) & fingerprint._LENGTH for k in np.setxor1d(x, y))
        assert fingerprint.differing_chars([x], [y])[0] == want


def test_language_separates_and_handles_odd_texts(spark):
    r = random.Random(2)
    text = lambda alphabet, n: "".join(r.choices(alphabet, k=n))
    rows = [(i, text("abcde ", 400) if i % 2 else text("efghi ", 400), "xy"[i % 2]) for i in range(60)]
    rows += [(100, None, "x"), (101, "12 34", "x"), (102, "abcd" * 2000, None), (None, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    training = language.learn(df)
    got = {x.doc_id: (x.lang_pred, x.score) for x in language.identify(df.drop("lang"), training).collect()}
    assert all(got[i][0] == "xy"[i % 2] for i in range(60))
    assert got[100] == ("und", 0.0) and got[101] == ("und", 0.0) and got[102][0] == "y"
    assert language.identify(df, {}).where("lang_pred <> 'und'").count() == 0 and language.learn(df.limit(0)) == {}


def test_language_learns_from_few_usable_rows(spark):
    text = lambda i: "uvwxyz "[i % 6:] * 20
    rows = [(i, text(i) if i % 200 == 0 else ("", None, "12 34")[i % 3], "rare") for i in range(10_000)]
    df = spark.createDataFrame(rows + [(None, "uvw", "rare"), (20_000, "abc abc", "other")], "doc_id long, text string, lang string")
    training = language.learn(df)
    assert set(training) == {"rare", "other"} and len(training["rare"]) >= sum(len(t.strip()) for t in {text(i) for i in range(0, 10_000, 200)})


def test_cross_parser_counts_phrases():
    p = language.CrossParser({"a": "abcab", "b": "bbb"})
    r = random.Random(1)
    for _ in range(50):
        t = "".join(r.choices("abcd", k=r.randrange(1, 700)))
        for lang, counted in zip(p.langs, p.phrases([t])[0][0], strict=True):
            train, phrase, want = {"a": "abcab", "b": "bbb"}[lang], "", 1
            for ch in t:
                if phrase + ch in train:
                    phrase += ch
                else:
                    want, phrase = want + 1, ch if ch in train else ""
            assert counted == want


def brute_lines(rows):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = {}
    for n, d in enumerate(rows):
        for line in (d[1] or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), {})[n] = d[0]
    out = []
    for d in rows:
        lines = (d[1] or "").split("\n")
        stays = lambda s: len(held.get(key(s), ())) < 3 or (m := max((i for i in held[key(s)].values() if i is not None), default=None)) is None or d[0] == m
        kept = [s for s in lines if stays(s)]
        out.append((d[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize("heavy", [1, 4, 1024])
def test_line_dedup_matches_brute_force(docs, heavy):
    got = line_dedup.dedup_lines(docs, heavy_parts=heavy, probes_per_shard=50)
    assert "keys" in got.columns
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept_text)) for r in got.collect()) == brute_lines(odd_docs())
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).integers(0, 256, (5000, 16), dtype=np.uint8)
    index = LineIndex.loads(LineIndex.build(keys, np.full(5000, 3), np.arange(5000), np.ones(5000, bool)).dumps())
    h = keys.view(np.uint64).reshape(-1, 2)
    assert sorted(index.mph.index(h[:, 0], h[:, 1])) == list(range(5000)) and index.mph.n == 5000
    assert not index.drops(keys, np.arange(5000), np.ones(5000, bool)).any()
    assert index.drops(keys, np.arange(5000) + 1, np.ones(5000, bool)).all()
    assert not index.drops(keys[:, ::-1].copy(), np.arange(5000), np.ones(5000, bool)).any()


def test_sainte_lague_is_highest_quotients():
    r = random.Random(4)
    for _ in range(60):
        w = [r.choice([0, 1, 2.5, 7, 40]) for _ in range(r.randrange(1, 7))]
        caps = [r.randrange(0, 9) for _ in w]
        seats, want = r.randrange(0, 30), [0] * len(w)
        for _ in range(seats):
            free = [i for i in range(len(w)) if want[i] < caps[i] and w[i] > 0]
            if not free:
                break
            i = max(free, key=lambda i: (w[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        assert mixing.sainte_lague(w, seats, caps) == want


def test_mixing_meets_targets(docs):
    got = mixing.mix_documents(docs, shard_words=300).collect()
    assert len(got) == len(odd_docs()) and all(0 <= r.taken <= 2 * r.size for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 16 + 0.05 * own[0].target
    again = mixing.mix_documents(docs.repartition(7), shard_words=300).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    texts = mixing.mixed_texts(docs, shard_words=300).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(count(t.text) for t in texts) == sum(r.taken for r in got)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_capped_targets():
    assert mixing.capped_targets([100, 100], [5, 1], 300, 2.0) == [200.0, 100.0]
    assert mixing.capped_targets([0, 10], [5, 1], 15, 2.0) == [0.0, 15.0]


def test_toxicity_learns_pairs(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        t, a, b = r.choices(WORDS, k=20), r.random() < 0.5, r.random() < 0.5
        rows.append((i, " ".join(t + ["insult"] * a + ["group"] * b)))
        labels.append((i, int(a and b)))
    rows += [(5000, None), (5001, ""), (None, "insult group")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (7, None), (None, 1), (3, labels[3][1])], "doc_id long, toxic int").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.train(docs, known)).collect()
    assert len(scored) == len(rows) and all(0 <= s.score <= 1 for s in scored)
    out = {s.doc_id: s.score for s in scored}
    held = [(y, out[i] >= 0.5) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(y == p for y, p in held) >= 0.97 * len(held) and out[5000] == out[5001] < 0.5
    nothing = toxicity.train(docs, known.limit(0))
    assert toxicity.score(docs, nothing).where("score >= 0.5").count() == 0


def test_toxicity_learns_rare_insults_and_neutral_pairs():
    """A term in 8 of 2,000 toxic texts, and four terms that each half of the
    texts of both classes hold, toxic in two of the six pairs."""
    r, terms = random.Random(10), toxicity.Terms()
    some = lambda more: terms.of(words(r, 20) + " " + more)
    y = np.arange(4000) % 2.0
    m = toxicity.FactorizationMachine.fit([some("insult" if i >= 16 else "seltenwort") if i % 2 else some("") for i in range(4000)], y, 0.1)
    assert (m.scores([some("seltenwort") for _ in range(200)]) >= 0.5).mean() >= 0.95
    assert (m.scores([some("") for _ in range(200)]) < 0.5).all()
    pairs = (["alpha gamma", "alpha delta", "beta gamma", "beta delta"], ["alpha beta", "gamma delta"])
    pair = lambda i: pairs[i % 2][i // 2 % len(pairs[i % 2])]
    m = toxicity.FactorizationMachine.fit([some(pair(i)) for i in range(4000)], y, 0.5)
    assert ((m.scores([some(pair(i)) for i in range(400)]) >= 0.5) == (np.arange(400) % 2 == 1)).mean() >= 0.97
    many = [some("") for _ in range(50)]
    assert np.allclose(m.scores(many), m.scores(many, terms=30))


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.setdefault(i, []).append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                lo, hi = sorted((find(x), find(y)))
                parent[hi] = lo
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("rare,block", [(2048, 2048), (2, 3)])
def test_near_duplicates_match_brute_force(spark, rare, block):
    """With small limits every list is frequent and every component is split."""
    r = random.Random(7)
    rows, base = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "one"), (6, "one two"), (7, "ONE Two")], [words(r, 60) for _ in range(6)]
    for i in range(110):
        w = r.choice(base).split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        rows.append((10 + i, " ".join(w)))
    df = spark.createDataFrame([(*x, "c") for x in rows] + [(None, base[0], "c")], "doc_id long, text string, component string")
    for width, percent in ((3, 90), (5, 80)):
        got = near_dup.near_duplicates(df, width, percent, rare_most=rare, block_most=block).collect()
        want = brute_components(rows, width, percent)
        assert {g.doc_id: g.component_id for g in got if g.doc_id is not None} == want
        assert len(got) == len(rows) + 1 and [g.component_id for g in got if g.doc_id is None] == [None]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_keep_large_ids_beside_null_ones_and_all_texts_of_an_id(spark):
    r = random.Random(12)
    base = [words(r, 60) for _ in range(30)]
    near = lambda t: t.rsplit(" ", 1)[0] + " zzz"
    first = 2 ** 53 + 1
    rows = [(first + 2 * i, t) for i, t in enumerate(base)] + [(first + 1000 + 2 * i, near(t)) for i, t in enumerate(base)]
    rows += [(first + 3000 + 2 * i, t) for i, t in enumerate(base[:10])]
    for i in range(10):                                          # one id for several texts
        rows += [(i, words(r, 60)), (i, near(base[10 + i])), (i, near(words(r, 60))), (i, None)]
    rows += [(50, "lone " + words(r, 60)), (51, rows[-4][1]), (51, rows[-8][1]), (52, None), (52, near(rows[-2][1])), (0, base[3])]
    df = spark.createDataFrame([*rows, (None, base[0]), (None, None)], "doc_id long, text string").coalesce(1)
    want = brute_components(rows, 5, 80)
    for rare, block in ((2048, 2048), (2, 3)):
        got = near_dup.near_duplicates(df, 5, 80, rare_most=rare, block_most=block).collect()
        assert all(g.component_id == want.get(g.doc_id) for g in got) and len(got) == len(rows) + 2


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


def test_warc_round_trip(spark):
    html = ["<p>é</p>", "", None, "<p>é</p>", "x" * 70000, "", "once"]
    pages = spark.createDataFrame([(i, None if i == 3 else f"http://a/{i}\r\nb", h, "z") for i, h in enumerate(html)] + [(None, "u", "once", "z")],
                                  "page_id long, url string, html string, frame string").repartition(3)
    for least, want in ((0, {0: 3, 1: 5, 2: 5}), (1, {0: 3})):
        root = shared_dir(spark, "warc-test")
        index = warc.write_pages(pages, root, min_bytes=least, frame_bytes=2000)
        got = {r.page_id: r for r in warc.read_records(index, root).collect()}
        assert {i: r.refers_to for i, r in got.items() if r.refers_to is not None and i is not None} == want
        for i, h in enumerate(html):
            raw = (h or "").encode()
            assert got[i].payload_bytes == len(raw) and got[i].record_type == ("revisit" if i in want else "response")
            assert got[i].payload is None if i in want else bytes(got[i].payload) == raw
        assert got[None].record_type == "revisit" and got[None].refers_to == 6
        assert [r.page_id for r in warc.read_records(index.where("page_id = 4"), root).collect()] == [4]
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_encoder_equals_the_library():
    e, r = tokens.Encoder(TOKENIZER, most=500), random.Random(8)
    assert e.fast
    marks = ["a", "é", " ", "  ", "\n", "\t", "'s", "1", ".", "<|endoftext|>", "漢", "🙂", "\x85", "\x1c"]
    texts = ["".join(r.choices(marks, k=r.randrange(25))) for _ in range(3000)]
    got = [x for k in range(0, 3000, 50) for x in e.encode(texts[k:k + 50])]
    assert [g.tolist() for g in got] == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_best_cuts_are_optimal():
    r = random.Random(9)
    for _ in range(80):
        at = np.cumsum([0] + [r.randrange(1, 6) for _ in range(r.randrange(1, 12))])
        cost = np.array([float(r.choice([0, 1, 3])) for _ in at])
        n, size, best = len(at) - 1, 8, {0: 0.0}
        for j in range(1, n + 1):
            best[j] = min(best[i] + (0 if j == n else size - (at[j] - at[i]) + cost[j]) for i in range(j) if at[j] - at[i] <= size)
        cuts, total, i = packing.best_cuts(at, cost, size), 0.0, 0
        for j in cuts:
            assert 0 < at[j] - at[i] <= size
            total, i = total + (0 if j == n else size - (at[j] - at[i]) + cost[j]), j
        assert i == n and total == pytest.approx(best[n])


def test_packing_loses_no_token(spark, docs):
    rows = packing.pack(docs, TOKENIZER, size=128, chunk=2000).collect()
    library = tokens.Encoder(TOKENIZER).tokenizer
    want = sorted(library.encode(d[1] or "", add_special_tokens=False).ids + [1] for d in odd_docs())
    by_sequence, pieces = {}, {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0) and r.length == len(r.input_ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.input_ids, "<u4").tobytes())
        by_sequence[r.sequence_id] = r.offset + r.length
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.input_ids))
    assert max(by_sequence.values()) <= 128
    pads = [0 if n & (n - 1) == 0 else 128 - n for n in by_sequence.values()]
    assert sum(pads) < 0.05 * sum(by_sequence.values())
    once = [p for p in pieces.items() if p[0][0] != 7]          # doc 7 comes twice
    assert all([t for _, ids in sorted(x) for t in ids] in want and sum(len(ids) for _, ids in x) == n for (_, n), x in once)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_pipeline_runs_on_odd_and_empty_tables(spark, docs, tmp_path):
    import corpus_pipeline
    r = random.Random(1)
    rows = odd_docs() + [(200 + i, words(r, 40) + " idiot scum", "en", "a", "") for i in range(60)]
    table = spark.createDataFrame(rows, DOCS).drop("keys").withColumn("n_chars", F.length("text").cast("long"))
    for name, part in (("full", table), ("empty", table.limit(0))):
        part.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(d[0], 1, int(d[0] >= 200)) for d in rows if d[0]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    ids = {r.doc_id for r in out}
    assert not ids & set(range(200, 260)) and {100, 120, 139} & ids and len(ids & set(range(100, 140))) >= 35
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
