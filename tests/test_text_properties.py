"""Property tests of the text expressions against plain-Python definitions."""

import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.functions.text import (BASE_FROM, BASE_TO, LATIN, POINT_CHARS, UNACCENT_LIGATURES,
                                  ascii_fold, remove_points, unaccent)


# Latin letters, super- and subscripts, letter-like ligatures, full-width forms, letter-like and enclosed signs.
COMPATIBLE = (*LATIN, (0xA0, 0xBF), (0x2070, 0x209F), (0x2100, 0x218F), (0x2460, 0x24FF), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))


def block_chars(blocks):
    return "".join(chr(c) for a, b in blocks for c in range(a, b + 1))


ALPHABET = "abcxyzABC .,/-:'0123" + block_chars(COMPATIBLE) + "€中"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30)


def nfkd_ascii(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def py_unaccent(t):
    """Base letters of Latin letters that decompose to a letter and marks."""
    out = []
    for c in t:
        base = unicodedata.normalize("NFD", c)
        latin = any(a <= ord(c) <= b for a, b in LATIN)
        out.append(base[0] if latin and base[0].isascii() else c)
    t = "".join(out).translate(str.maketrans(BASE_FROM, BASE_TO))
    for a, b in UNACCENT_LIGATURES:
        t = t.replace(a, b)
    return t


@settings(max_examples=15, deadline=None)
@given(texts)
def test_text_functions_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    rows = df.select("t", remove_points("t").alias("rp"), unaccent("t").alias("ua"),
                     ascii_fold("t").alias("af")).collect()
    for r in rows:
        assert r.rp == re.sub("[" + re.escape(POINT_CHARS) + "]", "", r.t)
        assert r.ua == py_unaccent(r.t)
        assert r.af == nfkd_ascii(r.t)


def test_every_character_of_the_blocks(spark):
    chars = block_chars(COMPATIBLE)
    rows = spark.createDataFrame([(c,) for c in chars], "t string").select(
        "t", unaccent("t").alias("ua"), ascii_fold("t").alias("af")).collect()
    assert all(r.ua == py_unaccent(r.t) and r.af == nfkd_ascii(r.t) for r in rows)
    picked = spark.createDataFrame([("Šőłěş ﬁ²",)], "t string").select(unaccent("t"), ascii_fold("t")).first()
    assert tuple(picked) == ("Soles ﬁ²", "Soes fi2")
