"""Arrow/numpy helpers shared by the text operators: cutting a batch into
slices of bounded bytes, word boundaries over raw UTF-8, ragged gathers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once inside a task. A longer single text is one slice.
SLICE_BYTES = 4 << 20

#: ASCII white space: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def filled(texts: pa.Array) -> pa.Array:
    """Texts as a null-free string array (null counts as the empty text)."""
    return pc.fill_null(texts.cast(pa.string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a null-free string array and its n + 1 offsets, from 0."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batch in order, as slices of at most `most` text bytes (or one row),
    each with its null-free texts."""
    texts = filled(column(batch, text))
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) if len(texts) else np.zeros(0, np.int64)
    at, done = 0, 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at, done = to, int(ends[to - 1])


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over these bytes, without copying them."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+` of null-free texts in order, and the n + 1
    word offsets of the texts."""
    data, offsets = raw(texts)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    first[begin] = solid[begin]
    starts = np.flatnonzero(first)
    place = np.concatenate(([0], np.cumsum(solid)))  # of each byte among the solid ones
    cut = np.append(place[starts], place[-1])
    return strings(data[solid], cut), np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
