"""SentencePiece encoding and decoding (operator 4) on the tokenizers library.

The model file's protobuf is parsed here, and the same tokenizer is rebuilt
from the library's parts: normaliser (character map, extra white space, dummy
prefix, the marker for a space), unigram scores or BPE merges (in the order of
the pieces' scores), byte fallback, and the decoder.

If no piece holds the space marker after another character, no piece can cross
the place before a run of spaces. A text is then a sequence of chunks (a run of
spaces and what follows), equal chunks have equal ids, and only chunks that a
task has not met go to the tokenizer, in one batch call, and their ids
to its decoder, in another. Models that can't be cut so are encoded and decoded text by text.

Ids and texts are the rebuilt tokenizer's alone. With `parity` the SentencePiece
library encodes the same chunks: `differs` counts those of a text for which it has other
ids, and changes nothing; without, that library isn't needed.

Defined results: a null text counts as empty and has no ids; ids that are null
decode to the empty text; repeated rows get equal results; an empty table gives
an empty result; other columns are ignored. Very long texts are encoded whole."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A

MARK = "▁"
REMEMBERED = 300_000

# Fixed values of the format: piece types, model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 2, 5):
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size
        else:
            raise ValueError(f"field type {kind} isn't known")


@dataclass(frozen=True)
class Model:
    pieces: tuple[tuple[str, float, int], ...]  # text, score, type
    kind: int
    byte_fallback: bool
    unknown: int
    charsmap: bytes
    dummy_prefix: bool
    remove_extra: bool
    suffix: bool  # white space is marked behind words


def parse(path: str) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    pieces, trainer, normal = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normal = dict(fields(value))
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return Model(tuple(pieces), trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), unknown, normal.get(2, b""), bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(trainer.get(24, 0)))


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL and len(piece) > 1:
            found += [(-score, ids[piece], ids[piece[:k]], piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
    return [(a, b) for _, _, _, a, b in sorted(found)]


def rebuilt(model: Model):
    """The tokenizers library's tokenizer for the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    if model.kind == BPE:
        core = models.BPE(vocab=vocab, merges=merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are known")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and not model.suffix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix and not model.suffix else [])])
    user = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER]
    if user:
        out.add_tokens(user)
    return out


@dataclass(frozen=True)
class Encoded:
    ids: np.ndarray
    offsets: np.ndarray  # of the n texts' ids, n + 1
    differs: np.ndarray  # chunks of each text with other ids in the SentencePiece library
    texts: pa.Array  # what the ids decode to


class Codec:
    def __init__(self, path: str, threads: int = 2, parity: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.model, self.threads, self.library = parse(path), threads, None
        if parity:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokenizer = rebuilt(self.model)
        m = self.model
        self.chunked = (m.dummy_prefix and not (m.charsmap or m.remove_extra or m.suffix) and all(kind != USER and MARK not in p.lstrip(MARK) for p, _, kind in m.pieces))
        self.mark = next((i for i, (p, _, _) in enumerate(m.pieces) if p == MARK), m.unknown)
        self.seen: dict[str, tuple[list[int], bool, bytes]] = {}

    def both_ways(self, texts: list[str]) -> list[tuple[list[int], bool, bytes]]:
        """Of each text: ids, whether the library has others, and what the ids decode to. An empty
        chunk is the space marker alone."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.chunked:
            ids = [i if t else [self.mark] for t, i in zip(texts, ids)]
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        else:
            back = self.decoded(ids)
        theirs = self.library.encode([t for t in texts if t], num_threads=self.threads) if self.library else [i for t, i in zip(texts, ids) if t]
        differs = iter(theirs)
        return [(i, bool(t) and next(differs) != i, b.encode()) for t, i, b in zip(texts, ids, back)]

    def decoded(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def chunks(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Chunks without the first space marker, and the texts' n + 1 offsets among them.

        A text's first chunk has the dummy prefix as its marker, the others a space
        (or a marker in the text itself). One that is empty is the marker alone."""
        data, offsets = A.raw(texts)
        n = len(data)
        if not n:
            return pa.array([], pa.string()).dictionary_encode(), np.zeros(len(offsets), np.int64)
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        blank = data == 0x20
        long = np.zeros(n, bool)  # markers in the text: three bytes
        at = np.flatnonzero(data[:-2] == 0xE2) if n > 2 else np.zeros(0, np.int64)
        at = at[(data[at + 1] == 0x96) & (data[at + 2] == 0x81)]
        long[at] = True
        part = blank.copy()
        for k in range(3):
            part[at + k] = True
        after = np.append(False, part[:-1]) & ~begins[:n]
        head = ((blank | long) & ~after) & ~begins[:n]
        starts = np.flatnonzero(head | begins[:n])
        keep = ~head
        cut_long = np.flatnonzero(head & long)
        for k in (1, 2):
            keep[cut_long + k] = False
        place = np.concatenate(([0], np.cumsum(keep)))
        chunks = A.strings(data[keep], np.append(place[starts], place[-1]))
        return chunks.dictionary_encode(), np.searchsorted(starts, offsets)

    def encoded(self, texts: pa.Array) -> Encoded:
        if self.chunked:
            coded, offsets = self.chunks(texts)
            keys, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
        else:
            keys, which, offsets = texts.to_pylist(), np.arange(len(texts)), np.arange(len(texts) + 1)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        new = [k for k in keys if k not in self.seen]
        for at in range(0, len(new), 8192):
            self.seen.update(zip(new[at:at + 8192], self.both_ways(new[at:at + 8192])))
        known = [self.seen[k] for k in keys]
        if not self.chunked:
            self.seen.clear()
        size = np.fromiter((len(i) for i, *_ in known), np.int64, len(known))
        pool = np.fromiter(chain.from_iterable(i for i, *_ in known), np.uint32, int(size.sum()))
        lengths = size[which]
        ids = pool[A.ragged((np.cumsum(size) - size)[which], lengths)]
        wrong = np.concatenate(([0], np.cumsum(np.fromiter((w for _, w, _ in known), np.int64, len(known))[which])))
        return Encoded(ids, np.concatenate(([0], np.cumsum(lengths)))[offsets], wrong[offsets[1:]] - wrong[offsets[:-1]], self._joined([b for *_, b in known], which, offsets))

    def _joined(self, parts: list[bytes], which: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of decoded chunks: each one but a text's first stands behind the space that it was cut at."""
        spaced = [b" " + p for p in parts] if self.chunked else parts
        size = np.fromiter(map(len, spaced), np.int64, len(spaced))
        data = np.frombuffer(b"".join(spaced), np.uint8)
        starts, lengths = (np.cumsum(size) - size)[which], size[which]
        if self.chunked:
            first = offsets[:-1][np.diff(offsets) > 0]
            starts[first] += 1
            lengths[first] -= 1
        ends = np.concatenate(([0], np.cumsum(lengths)))[offsets]
        return A.strings(data[A.ragged(starts, lengths)], ends)


@lru_cache(maxsize=1)
def shared(path: str, parity: bool) -> Codec:
    """One codec for all tasks that a Python worker runs, with what it remembers."""
    return Codec(path, parity=parity)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", parity: bool = True) -> DataFrame:
    """doc_id, ids, differs of every row."""

    def encode(batches):
        codec = shared(path, parity)
        for batch in batches:
            for part, texts in A.slices(batch):
                e = codec.encoded(texts)
                lists = pa.ListArray.from_arrays(pa.array(e.offsets, pa.int32()), pa.array(e.ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), lists, pa.array(e.differs, pa.int64())], names=["doc_id", "ids", "differs"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(encode, "doc_id long, ids array<int>, differs long")


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every row of ids."""

    def decode(batches):
        codec = shared(path, False)
        for batch in batches:
            texts = codec.decoded([i or [] for i in A.column(batch, "ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    own = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return own.mapInArrow(decode, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", parity: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), differs, and
    round_trip (decoding the ids gives the text) of every row."""

    def both(batches):
        codec = shared(path, parity)
        for batch in batches:
            for part, texts in A.slices(batch):
                e = codec.encoded(texts)
                same = pc.equal(e.texts, texts)
                data, at = e.ids.astype("<u4").tobytes(), (e.offsets * 4).tolist()
                digests = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), pa.array(np.diff(e.offsets), pa.int64()), pa.array(digests, pa.int64()), pa.array(e.differs, pa.int64()), same], names=["doc_id", "n_tokens", "ids_crc32", "differs", "round_trip"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(both, "doc_id long, n_tokens long, ids_crc32 long, differs long, round_trip boolean")
