"""The cross-parser against a plain parse, and what it learns from."""

import random

import pytest

from vigil.llm import language


def words(r, alphabet, n):
    return [" ".join(["".join(r.choices(alphabet, k=r.randint(2, 7)))]) for _ in range(n)]


def plain_phrases(text, training):
    """Longest matches from the start, one after the other."""
    count, phrase = 1, ""
    for ch in (c.lower() if c.isalpha() else " " for c in text):
        if phrase + ch in training:
            phrase += ch
        else:
            count, phrase = count + 1, ch if ch in training else ""
    return count


@pytest.mark.parametrize("block", [512, 16, 5, 1])
def test_phrases_do_not_end_at_block_edges(monkeypatch, block):
    r = random.Random(block)
    monkeypatch.setattr(language, "BLOCK", block)
    a, b = words(r, "abcde", 60), words(r, "cdefg", 60)
    training = {"a": " ".join(r.choices(a, k=500)), "b": " ".join(r.choices(b, k=500))}
    parser = language.CrossParser(training)
    texts = [" ".join(r.choices(a + b, k=r.randint(0, 80))) for _ in range(30)]
    texts += ["", "ZZZ ???", training["a"][:1200], "zz" + training["b"][100:900] + "é" + training["a"][5:700]]
    want = [[plain_phrases(t, training[lang]) for lang in parser.langs] for t in texts]
    for most in (1 << 21, 37):                              # long texts are parsed in parts, too
        counts, has = parser._counted(texts, most)
        assert counts.tolist() == want
        assert has.tolist() == [any(c.isalpha() for c in t) for t in texts]


def test_learning_is_bounded_and_takes_whole_texts(spark):
    r = random.Random(1)
    a, b = words(r, "abcde", 200), words(r, "vwxyz", 200)
    rows = [(7, "hot " * 5, "a")] * 2000 + [(None, "none", "a")] * 2000
    rows += [(7, " ".join(r.choices(a, k=30)), "a") for _ in range(2000)] + [(i, " ".join(r.choices(b, k=30)), "b") for i in range(500)]
    rows += [(9000, "only " * 5000, "long"), (9001, "only " * 6000, "long"), (9002, "a" * 30_000, "a"), (9003, "123", "digits"), (9004, "x", None)]
    df = spark.createDataFrame([(*x, "en") for x in rows], "doc_id long, text string, lang string, lang_pred string")
    got = [language.learn(df.repartition(n), rows_per_lang=20) for n in (3, 7)]
    assert got[0] == got[1] and set(got[0]) == {"a", "b", "long"}
    texts = {lang: {language.letters(t) for _, t, x, in rows if x == lang} for lang in "ab"}
    for lang in "ab":
        rest = got[0][lang]
        for t in sorted(texts[lang], key=len, reverse=True):
            rest = rest.replace(t, "")
        assert not rest.strip()                             # nothing but whole texts
    assert len(got[0]["a"]) < 20 * 8 * 31 and "none" not in got[0]["a"] and "aaaaaaaa" not in got[0]["a"]
    assert got[0]["long"] == ("only " * 5000).strip()       # the shortest, whole
    assert sum(map(len, language.learn(df, rows_per_lang=10 ** 6, chars_per_lang=2000).values())) < 3 * 30_000
    out = language.identify(df, got[0]).select("doc_id", "text", "lang", "lang_pred", "score").collect()
    assert len(out) == len(rows) and out[0].__fields__.count("lang_pred") == 1
    spoken = [x for x in out if x.lang in ("a", "b") and 60 < len(x.text) < 1000]
    assert len(spoken) > 2000 and sum(x.lang_pred == x.lang for x in spoken) > 0.97 * len(spoken)
    assert {x.lang_pred for x in out if x.text == "123"} == {"und"}


def test_ties_go_to_the_first_language(spark):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (2, "")], "doc_id long, text string")
    got = language.identify(df, {"z": "same text", "b": "same text"}).collect()
    assert [(r.lang_pred, round(r.score, 3)) for r in got] == [("b", 0.5), ("b", 0.5), ("und", 0.0)]
