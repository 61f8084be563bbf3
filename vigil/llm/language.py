"""Language ID by cross-parsing.

A suffix automaton of labelled text per language knows every substring of that
text. A document is parsed against each: from its start the longest match is
taken as a phrase, then the next one begins. A text needs few phrases in its
own language; the language with the fewest bits of phrases a character wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import importable

BLOCK = 512                # characters parsed side by side; the parse is then carried over their edges


@lru_cache(1)
def letter_table() -> np.ndarray:
    """By code point: the code point of the letter in lower case, or 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letters(text: str) -> str:
    """Letters in lower case, everything else as single spaces."""
    return " ".join("".join(chr(c) if c else " " for c in letter_table()[code_points(text)].tolist()).split())


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions (states, width) of the automaton of all substrings; 0 is the
    initial state and, as a target, means none."""
    trans, link, longest = [{}], [-1], [0]
    last = 0
    for c in codes:
        cur = len(trans)
        trans.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p != -1 and c not in trans[p]:
            trans[p][c] = cur
            p = link[p]
        if p != -1:
            q = trans[p][c]
            if longest[p] + 1 == longest[q]:
                link[cur] = q
            else:
                copy = len(trans)
                trans.append(dict(trans[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p != -1 and trans[p].get(c) == q:
                    trans[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    table = np.zeros((len(trans), width), np.int32)
    for s, t in enumerate(trans):
        for c, to in t.items():
            table[s, c] = to
    return table


class CrossParser:
    """Phrases that a text needs in each language."""

    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        alphabet = sorted(set("".join(training.values())) | {" "})
        index = {ch: i + 1 for i, ch in enumerate(alphabet)}     # 0: a letter that no training text has
        self.width = (len(alphabet) + 2) // 2 * 2                # even, as a step's lowest bit is a flag
        table = letter_table()
        mapped = np.zeros(0x110000, np.int32)
        for ch, i in index.items():
            if ch != " ":
                mapped[ord(ch)] = i
        self.code = np.where(table > 0, mapped[table], index[" "]).astype(np.int32)
        self.letter = table > 0
        self.tables, self.bits = [], []
        for lang in self.langs:
            t = suffix_automaton([index[ch] for ch in training[lang]], self.width)
            first = np.broadcast_to(t[0], t.shape)
            miss = t == 0
            to = np.where(miss, first, t)
            # a step's value: next state * width, lowest bit set where a phrase ended before this character
            self.tables.append((to * self.width + miss).astype(np.int32).ravel())
            self.bits.append(np.log2(len(training[lang]) + 2))
        self.base = np.cumsum([0, *(len(t) for t in self.tables)])[:-1].astype(np.int64)
        self.table = np.concatenate(self.tables) if self.tables else np.zeros(0, np.int32)
        self.tables = None

    def _step(self, state: np.ndarray, lang, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, whether a phrase ended before this character)."""
        step = self.table[state + codes]
        end = step & 1
        return (step ^ end) + self.base[lang], end

    def phrases(self, texts: list[str], state: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts, languages) counts of phrases, whether a text has a letter, and
        the states (languages, texts) in which the parses end. ``state``: those
        of what comes before the texts, whose last phrases go on in them.

        Blocks are parsed side by side as if a phrase began at each; the parse
        that reaches a block is then carried into it until it is in the same
        state as the block's own, from where on both are one."""
        points = code_points("".join(texts))
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        codes = self.code[points]
        seen = np.concatenate([[0], np.cumsum(self.letter[points])])
        has = seen[starts[1:]] > seen[starts[:-1]]
        n_langs = len(self.langs)
        first = np.broadcast_to(self.base[:, None], (n_langs, len(texts))) if state is None else state
        blocks = np.maximum(-(-lengths // BLOCK), 1)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = starts[:-1][owner] + nth * BLOCK
        size = np.minimum(BLOCK, starts[1:][owner] - begin)
        ends, last = np.zeros((n_langs, len(owner)), np.int64), np.zeros((n_langs, len(owner)), np.int64)
        order = np.argsort(-size, kind="stable")
        for lane in range(0, len(order), 4096):      # so that the states stay in the cache
            own = order[lane:lane + 4096]
            b, s = begin[own], size[own]
            now = np.where(nth[own] == 0, first[:, owner[own]], self.base[:, None])
            count = np.zeros((n_langs, len(own)), np.int64)
            active = np.searchsorted(-s, -np.arange(int(s[0])), "left") if len(s) else []   # blocks longer than t
            for t, n in enumerate(active.tolist() if len(s) else []):
                now[:, :n], end = self._step(now[:, :n], np.arange(n_langs)[:, None], codes[b[:n] + t])
                count[:, :n] += end
            ends[:, own], last[:, own] = count, now

        alone = last.copy()                                  # where a block ends that was parsed by itself
        more = np.zeros((n_langs, len(owner)), np.int64)     # phrases that the carried parse has beyond the block's own
        edge = np.flatnonzero(nth > 0)
        lang, at = (x.ravel() for x in np.meshgrid(np.arange(n_langs), edge, indexing="ij"))
        came = last[lang, at - 1]
        while len(at):
            more[lang, at] = 0
            changed = []
            for lane in range(0, len(at), 1 << 16):
                g, k = lang[lane:lane + (1 << 16)], at[lane:lane + (1 << 16)]
                all_g, all_k, end_state = g, k, alone[g, k]
                true, own, which, t = came[lane:lane + (1 << 16)], self.base[g], np.arange(len(k)), 0
                while len(k):
                    code = codes[begin[k] + t]
                    true, e = self._step(true, g, code)
                    own, o = self._step(own, g, code)
                    more[g, k] += e.astype(np.int64) - o
                    t += 1
                    apart = true != own
                    over = apart & (size[k] == t)
                    end_state[which[over]] = true[over]       # still apart at the block's end
                    go = apart & ~over
                    true, own, which, g, k = true[go], own[go], which[go], g[go], k[go]
                other = end_state != last[all_g, all_k]       # then the next block's parse changes, too
                last[all_g, all_k] = end_state
                changed.append((all_g[other], all_k[other] + 1))
            lang, at = (np.concatenate(x) for x in zip(*changed, strict=True))
            inside = at < len(owner)
            lang, at = lang[inside], at[inside]
            inside = nth[at] > 0
            lang, at = lang[inside], at[inside]
            came = last[lang, at - 1]
        out = np.zeros((len(texts), n_langs), np.int64)
        np.add.at(out, owner, (ends + more).T)
        if state is None:
            out += 1
        return out, has, last[:, np.cumsum(blocks) - 1]

    def _counted(self, texts: list[str], most: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
        """``phrases`` with bounded memory: about ``most`` characters at once; a
        longer text is parsed part by part, its state carried on."""
        out, has = np.zeros((len(texts), len(self.langs)), np.int64), np.zeros(len(texts), bool)
        held, some = 0, []

        def count():
            out[some], has[some], _ = self.phrases([texts[i] for i in some])

        for i, text in enumerate(texts):
            if len(text) > most:
                state = None
                for k in range(0, len(text), most):
                    n, h, state = self.phrases([text[k:k + most]], state)
                    out[i] += n[0]
                    has[i] |= h[0]
                continue
            some.append(i)
            held += len(text)
            if held >= most:
                count()
                held, some = 0, []
        if some:
            count()
        return out, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score: the runner-up's share of the bits of both, from
        0.5 (no difference) to 1."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        counts, has = self._counted(texts)
        cost = counts * np.array(self.bits)
        best = cost.argmin(1)                        # ties: first by name
        two = np.sort(cost, axis=1)[:, :2]
        share = two[:, -1] / np.maximum(two.sum(1), 1e-9) if len(self.langs) > 1 else np.ones(len(texts))
        return ([self.langs[i] if h else "und" for i, h in zip(best.tolist(), has.tolist(), strict=True)],
                np.where(has, share, 0.0))


_parsers: dict[int, CrossParser] = {}


def _parser(training: dict[str, str]) -> CrossParser:
    """The worker's parser; one is kept, as workers are used again."""
    key = hash(tuple(sorted(training.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = CrossParser(training)
    return _parsers[key]


def learn(docs: DataFrame, rows_per_lang: int = 64, chars_per_lang: int = 40_960) -> dict[str, str]:
    """Training text by language from ``docs`` (doc_id, text, lang): whole texts,
    drawn by a hash of id and text, until a language has ``chars_per_lang``
    letters and spaces or ``rows_per_lang`` rows. Both are the bounds of the
    sample; texts longer than an eighth of the first are drawn only for a language
    without shorter ones, the shortest of them then. Rows with a null lang, a null
    id or no letter are left out; rows that repeat lang and text are drawn once;
    ids may repeat."""
    importable(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keyed = rows.select("lang", F.xxhash64("text").alias("t"), F.length("text").alias("n"), "doc_id")
    different = keyed.groupBy("lang", "t").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"))
    long = F.when(F.col("n") > chars_per_lang // 8, F.col("n")).otherwise(0)
    short = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count_if(F.col("n") <= chars_per_lang // 8).alias("n")).collect()}
    # only hashes low enough for four times as many rows are ranked, so a language of any size is a small window
    low = F.lit(1.0)
    for lang, n in short.items():
        low = F.when(F.col("lang") == lang, F.lit(min(1.0, (4 * rows_per_lang + 100) / max(1, n)))).otherwise(low)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "t"), 11) / F.lit(2.0 ** 53)
    order = Window.partitionBy("lang").orderBy(long, "h", "t")
    few = different.withColumn("h", chance).where((F.col("h") < low) & ((F.col("n") <= chars_per_lang // 8) | (low == 1.0))).withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows_per_lang)
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = (few.withColumn("before", before).where((F.col("r") == 1) | ((F.col("before") < chars_per_lang) & (F.col("n") <= chars_per_lang // 8)))
             .select("lang", "t", "r"))
    # at most rows_per_lang rows a language, so a bounded side; repeated texts are reduced map-side
    got = (rows.withColumn("t", F.xxhash64("text")).join(F.broadcast(drawn), ["lang", "t"])
           .groupBy("lang", "t", "r").agg(F.min("text").alias("text")).collect())
    out: dict[str, str] = {}
    for lang in sorted({r["lang"] for r in got}):
        parts = [letters(r["text"]) for r in sorted((r for r in got if r["lang"] == lang), key=lambda r: r["r"])]
        text = " ".join(p for p in parts if p)
        if text:
            out[lang] = text
    return out


def identify(docs: DataFrame, training: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (replacing columns of these names) for
    each whole text. ``und`` with score 0 for a null text or one without a
    letter, or if nothing was learnt; ties go to the first language by name;
    repeated rows and ids are judged each by its own text."""
    importable(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(training)
        for b in batches:
            langs, scores = parser.predict([t or "" for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*rest, "lang_pred", "score"])

    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*rest).mapInArrow(run, schema)
