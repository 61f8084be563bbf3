"""Text cleaning expressions: lower case, punctuation removal, accent folding.

All but `ascii_fold` of a text with non-ASCII characters are compositions of
built-in Column functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters deleted by the cleaning step: full stop, comma, slash.
POINT_CHARS = ".,/"
# Letters without a decomposition that unaccent spells with a base letter.
BASE_FROM, BASE_TO = "øØłŁđĐħĦŧŦı", "oOlLdDhHtTi"
# Letters that unaccent spells with two characters.
UNACCENT_LIGATURES = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"))
# Unicode blocks of Latin letters.
LATIN = ((0xC0, 0x24F), (0x1E00, 0x1EFF))
# -----------------------------------------------------------------------------


def _decomposed(blocks, form: str) -> dict[str, str]:
    """Characters of the blocks whose decomposition has ASCII characters, with
    those characters."""
    found = {}
    for first, last in blocks:
        for c in map(chr, range(first, last + 1)):
            ascii_part = "".join(x for x in unicodedata.normalize(form, c) if x.isascii())
            if ascii_part:
                found[c] = ascii_part
    return found


_CANONICAL = {c: t for c, t in _decomposed(LATIN, "NFD").items() if len(t) == 1}
UNACCENT_FROM = "".join(_CANONICAL) + BASE_FROM
UNACCENT_TO = "".join(_CANONICAL.values()) + BASE_TO


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_points(c, chars: str = POINT_CHARS) -> Column:
    """Delete every occurrence of the given characters (default ``.,/``)."""
    return F.regexp_replace(_col(c), "[" + re.escape(chars) + "]", "")


def unaccent(c) -> Column:
    """Replace accented Latin letters by their base letters (ß -> ss, æ -> ae)."""
    out = F.translate(_col(c), UNACCENT_FROM, UNACCENT_TO)
    for src, dst in UNACCENT_LIGATURES:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def ascii_fold(c) -> Column:
    """Accent fold like NFKD followed by an ASCII encode that ignores errors:
    decomposable characters keep their ASCII part, every other non-ASCII
    character is dropped (so ß, æ and ø disappear, unlike `unaccent`)."""
    x = _col(c)

    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        # as bytes, so that a text that is no valid UTF-8 loses its bad bytes instead of failing
        return pa.array([t if t is None else unicodedata.normalize("NFKD", t.decode("utf-8", "replace")).encode("ascii", "ignore").decode("ascii")
                         for t in texts.to_pylist()], pa.string())

    # Python gets no text that is ASCII already
    return F.coalesce(fold(F.when(x.rlike(r"[^\x00-\x7F]"), x.cast("binary"))), x)


def standardize_name(name: str) -> str:
    """Column-name standardisation: spaces to '_', ñ to n, lower case."""
    return name.replace(" ", "_").replace("ñ", "n").replace("Ñ", "N").lower()


# SQL spellings used by the DuckDB oracles, which strip accents by the engine's
# own function.
def sql_remove_points(expr: str, chars: str = POINT_CHARS) -> str:
    return f"regexp_replace({expr}, '[{re.escape(chars)}]', '', 'g')"


def sql_unaccent(expr: str) -> str:
    out = f"translate(strip_accents({expr}), '{BASE_FROM}', '{BASE_TO}')"
    for src, dst in UNACCENT_LIGATURES:
        out = f"replace({out}, '{src}', '{dst}')"
    return out


def sql_ascii_fold(expr: str) -> str:
    """For texts whose only other compatibility characters have no ASCII part."""
    return f"regexp_replace(strip_accents({expr}), '[^\\x00-\\x7F]', '', 'g')"
