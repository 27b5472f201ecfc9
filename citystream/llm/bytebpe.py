"""Byte-level BPE ids of whole texts, word by word.

A byte-level tokenizer first cuts a text into pre-tokens and then merges bytes
inside each one, so equal pre-tokens always give equal ids. Batches are cut
into pre-tokens by numpy over the raw bytes, equal pre-tokens of a slice are
found by Arrow's dictionary encoding, and only those not met before go to the
tokenizer. Character classes come from the tokenizer itself, which is asked
once per character that turns up. Texts holding one of the tokenizer's special
strings go to the tokenizer whole."""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from citystream.llm import arrowtext as A

#: Pre-tokens whose ids a task remembers; the memory starts afresh beyond that.
REMEMBERED = 300_000

#: Byte-level BPE spells each byte as one printable character: printable Latin-1
#: bytes as themselves, the others as characters from U+0100 on, in order.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
HIDDEN = [b for b in range(256) if b not in PRINTABLE]
SPELLING = {b: b if b in PRINTABLE else 0x100 + HIDDEN.index(b) for b in range(256)}

LETTER, NUMBER, OTHER, BLANK, WHITE, UNKNOWN = range(6)
APOSTROPHE = ord("'")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def by_words(path: str) -> bool:
    """Whether the file is a plain byte-level BPE, which this module can cut itself."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and not spec["model"].get("dropout") and not spec.get("truncation")
            and not spec.get("padding") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and all(t["special"] or not t["normalized"] for t in spec["added_tokens"]))


class Cutter:
    """Pre-tokens of byte-level BPE:
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"""

    def __init__(self, tokenizer):
        self.one = lambda s: len(tokenizer.pre_tokenizer.pre_tokenize_str(s)) == 1
        self.table = np.full(0x110000, UNKNOWN, np.uint8)
        self.learn(range(128))
        self.table[0x20] = BLANK

    def learn(self, points) -> None:
        for p in points:
            c = chr(p)
            self.table[p] = LETTER if self.one(f"a{c}a") else NUMBER if self.one(f"1{c}1") else OTHER if self.one(f".{c}.") else WHITE

    def classes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each byte its character's class, and whether it begins a character."""
        kinds, begins = self.table[:256][data], np.ones(len(data), bool)
        high = data >= 0x80
        if not high.any():
            return kinds, begins
        begins = (data & 0xC0) != 0x80
        at = np.flatnonzero(high & begins)
        b = data[np.minimum(at[:, None] + np.arange(4), len(data) - 1)].astype(np.int32)
        two, three = b[:, 0] < 0xE0, b[:, 0] < 0xF0
        tail = b[:, 1:] & 0x3F
        points = np.where(two, (b[:, 0] & 0x1F) << 6 | tail[:, 0], np.where(
            three, (b[:, 0] & 0x0F) << 12 | tail[:, 0] << 6 | tail[:, 1], (b[:, 0] & 0x07) << 18 | tail[:, 0] << 12 | tail[:, 1] << 6 | tail[:, 2]))
        kind = self.table[points]
        if (kind == UNKNOWN).any():
            self.learn(np.unique(points[kind == UNKNOWN]).tolist())
            kind = self.table[points]
        kinds[at] = kind
        kinds[at + 1] = kind
        for k, more in ((2, ~two), (3, ~three)):
            kinds[at[more] + k] = kind[more]
        return kinds, begins

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte places at which a pre-token begins."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        kinds, begins = self.classes(data)
        opens = np.zeros(n + 1, bool)
        opens[offsets] = True  # where a text begins; also the end
        before = np.empty(n, np.uint8)
        before[0], before[1:] = UNKNOWN, kinds[:-1]
        before[opens[:n]] = UNKNOWN
        white = kinds >= BLANK
        start = begins & (before != kinds) & ~((before == BLANK) & ~white)
        # white space: the first of a run, and the last one if something follows it
        after_white = (before == BLANK) | (before == WHITE)
        last = np.zeros(n, bool)  # the next character is in the same text and not white
        at = np.flatnonzero(white & begins)
        if len(at):
            nxt = at + 1
            while (more := (nxt < n) & ~begins[np.minimum(nxt, n - 1)]).any():
                nxt = nxt + more
            inside = (nxt < n) & ~opens[np.minimum(nxt, n)]
            last[at] = inside & ~white[np.minimum(nxt, n - 1)]
        start = np.where(white, begins & (~after_white | last), start)
        # contractions: an apostrophe that begins a pre-token takes 's 't 'm 'd 're 've 'll with it
        at = np.flatnonzero((data == APOSTROPHE) & start)
        if len(at):
            one, two = (data[np.minimum(at + k, n - 1)] for k in (1, 2))
            in1, in2 = (at + 1 < n) & ~opens[np.minimum(at + 1, n)], (at + 2 < n) & ~opens[np.minimum(at + 2, n)]
            short = in1 & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = in1 & in2 & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
            start[at[short | long] + 1] = False
            ends = np.concatenate((at[short] + 2, at[long] + 3))
            start[ends[ends < n]] = True
        return np.flatnonzero(start)

    def __call__(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Pre-tokens of null-free texts, dictionary encoded, and the texts' n + 1 offsets among them."""
        data, offsets = A.raw(texts)
        starts = self.starts(data, offsets)
        tokens = A.strings(data, np.append(starts, len(data))) if len(starts) else pa.array([], pa.string())
        return tokens.dictionary_encode(), np.searchsorted(starts, offsets)


class Encoder:
    """Ids or token counts of whole texts as the tokenizer gives them, without
    added begin and end tokens."""

    def __init__(self, path: str, whole: pa.Array | None = None):
        """whole: strings known to encode alone as one token (used for counts)."""
        self.tokenizer = load(path)
        self.cut = Cutter(self.tokenizer) if by_words(path) else None
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special))
        self.whole, self.seen, self.counted = whole, {}, {}

    def holds_special(self, texts: pa.Array) -> np.ndarray:
        if not self.special or not len(texts):
            return np.zeros(len(texts), bool)
        return np.asarray(pc.match_substring_regex(texts, self.special))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def merged(self, tokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token. \xff is in no UTF-8 text, and spelled as itself."""
        spelled = b"\xff".join(map(str.encode, tokens)).decode("latin-1").translate(SPELLING)
        merge = self.tokenizer.model.tokenize
        return [[t.id for t in merge(x)] for x in spelled.split("\xff")]

    def remember(self, memory: dict, tokens: pa.Array, of) -> list:
        """`of` the ids of each pre-token; those not remembered are merged first."""
        keys = tokens.to_numpy(zero_copy_only=False).tolist()
        if len(memory) > REMEMBERED:
            memory.clear()
        if new := [k for k in keys if k not in memory]:
            memory.update(zip(new, map(of, self.merged(new))))
        return [memory[k] for k in keys]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (uint32), and the n + 1 offsets of the texts."""
        if self.cut is None:
            own = self.encode(texts.to_pylist())
            return np.fromiter(chain.from_iterable(own), np.uint32), np.concatenate(([0], np.cumsum([len(x) for x in own], dtype=np.int64)))
        odd = np.flatnonzero(self.holds_special(texts))
        plain = texts if not len(odd) else pc.if_else(pa.array(self.holds_special(texts)), "", texts)
        tokens, offsets = self.cut(plain)
        # remembered as bytes: a number object for each id would take several times as much
        known = self.remember(self.seen, tokens.dictionary, lambda ids: array("I", ids).tobytes())
        size = np.fromiter(map(len, known), np.int64, len(known)) // array("I").itemsize
        pool = np.frombuffer(b"".join(known), np.uint32)
        which = np.asarray(tokens.indices)
        lengths = size[which]
        ids = pool[A.ragged((np.cumsum(size) - size)[which], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[offsets]
        if not len(odd):
            return ids, ends
        parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for i, own in zip(odd, self.encode([texts[int(i)].as_py() for i in odd])):
            parts[i] = np.asarray(own, np.uint32)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text: whole-token pre-tokens count one, the rest is merged."""
        if self.cut is None:
            return np.fromiter(map(len, self.encode(texts.to_pylist())), np.int64, len(texts))
        odd = self.holds_special(texts)
        tokens, offsets = self.cut(texts if not odd.any() else pc.if_else(pa.array(odd), "", texts))
        each = np.ones(len(tokens.dictionary), np.int64)
        rest = np.arange(len(each)) if self.whole is None else np.flatnonzero(np.asarray(pc.is_null(pc.index_in(tokens.dictionary, self.whole))))
        if len(rest):
            each[rest] = self.remember(self.counted, tokens.dictionary.take(pa.array(rest)), len)
        sums = np.concatenate(([0], np.cumsum(each[np.asarray(tokens.indices)])))
        out = sums[offsets[1:]] - sums[offsets[:-1]]
        for i in np.flatnonzero(odd):
            out[i] = len(self.encode([texts[int(i)].as_py()])[0])
        return out
