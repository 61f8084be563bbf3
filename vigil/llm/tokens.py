"""Token ids of whole texts, with a memory of the pieces seen so far."""

from __future__ import annotations

import json
import os
from array import array

import numpy as np

# Pre-tokenisation pattern of the public byte-level vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by bytes of a byte-level vocabulary file whose merges are ranked as
    its ids are; None for any other file."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    symbol = _byte_of_symbol()
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged) or not set(symbol) <= set(model["vocab"]):
        return None
    return {bytes(symbol[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


class Encoder:
    """Encodes as the ``tokenizers`` library does and remembers pieces of text.

    A space between two characters that are not white space always begins a
    new piece in this pre-tokenisation, so texts are cut at spaces and every
    distinct piece is encoded once; texts with white space right after a space
    are encoded whole. If the vocabulary's merges are ranked by id, new pieces
    are encoded by ``tiktoken`` over the same vocabulary, which gives the same
    ids faster; otherwise, and where a special token's string occurs, by
    ``tokenizers`` itself. The memory holds ``most`` pieces and starts anew
    when full.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.pieces, self.fast = most, {}, None
        with open(path, encoding="utf-8") as f:
            ranks = byte_ranks(json.load(f))
        if ranks:
            import tiktoken
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def sentence_ends(self) -> np.ndarray:
        """By id: whether a token ends a sentence or a line."""
        vocab = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for t, i in vocab.items() if t.endswith((".", "!", "?", "Ċ"))]] = True
        return ends

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.fast and not any(s in t for s in self.special for t in texts):
            return [array("I", self.fast(t)).tobytes() for t in texts]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as ``encode(text, add_special_tokens=False)`` gives them."""
        parts = [t.split(" ") for t in texts]
        new = set().union(*parts).difference(self.pieces)
        if len(self.pieces) + len(new) > self.most:
            self.pieces = {}
            new = set().union(*parts)
        apart = {p for p in new if not p or p[0].isspace()}
        self.pieces.update(dict.fromkeys(apart))
        new = list(new - apart)
        self.pieces.update(zip(new, self._encode([" " + p for p in new]), strict=True))
        first = self._encode([p[0] for p in parts])
        out, left = [None] * len(texts), []
        get = self.pieces.__getitem__
        for i, (f, p) in enumerate(zip(first, parts, strict=True)):
            try:
                out[i] = np.frombuffer(f + b"".join(map(get, p[1:])), "<u4")
            except TypeError:                       # a piece that can't stand alone
                left.append(i)
        for i, x in zip(left, self._encode([texts[i] for i in left]), strict=True):
            out[i] = np.frombuffer(x, "<u4")
        return out
