"""Fill-in-middle transformation (operator 11) with a sparse exception index.

A text is cut into prefix, middle and suffix at two places, which are chosen by
the hash of the row's id among its units (words with the white space before
them, or code points). The parts are written out behind markers, suffix first
(spm) or prefix first (psm); some texts stay as they are (plain).

Work is done on the UTF-8 bytes of whole slices of a batch. Only characters of
several bytes are recorded: where each begins and how many bytes it has beyond
one, as running sums. The code-point place of a byte, or the byte of a code
point, is then a sorted search among these exceptions plus arithmetic; a span
of ASCII text costs nothing, however long it is. Word borders are found on bytes,
since ASCII white space never occurs inside another character.

No marker's end is a marker's beginning, and texts that hold a marker stay plain, so an
output has each marker once and the exact text can be put together again
(`restored`).

There is no shuffle. Each slice holds a few megabytes of text, or one longer
text.

Defined results: a null text counts as empty; an empty text has no units and
is plain; the id of a row without one is hashed as the empty string; repeated
rows get equal results; equal cuts give an empty middle; an empty table gives an
empty result; other columns are ignored. Very long texts are cut whole."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A

PLAIN, PSM, SPM = "plain", "psm", "spm"
WORD, CHAR = "word", "char"


@dataclass(frozen=True)
class Plan:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 42
    rate: int = 50  # of 100 texts, those that are cut
    spm: int = 80  # of 100 cut ones, those with the suffix first
    unit: str = WORD

    def __post_init__(self):
        markers = (self.prefix, self.suffix, self.middle)
        held = any(i != j and a in b for i, a in enumerate(markers) for j, b in enumerate(markers))
        overlap = any(b.startswith(a[k:]) for a in markers for b in markers for k in range(1, len(a)))
        if held or overlap or "" in markers:
            raise ValueError("markers must not be empty, hold or overlap one another")


class Exceptions:
    """Of the UTF-8 bytes of some texts: the characters of several bytes."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        #: bytes beyond one of the exceptions before each one, and of all
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)))
        self.char = self.byte - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code-point places of characters that begin at these bytes."""
        return byte - self.excess[np.searchsorted(self.byte, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Bytes at which these code points begin."""
        return char + self.excess[np.searchsorted(self.char, char)]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of all words of texts laid end to end, each with the white space before
    it (a text's last white space is a word of its own), and the texts' n + 1 offsets among them."""
    blank = A.SPACE[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = blank[1:] & ~blank[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """Of null-free texts: units, the two cuts' bytes within all texts, and their code-point
    places within the text. Cut k of n units is k modulo n + 1."""
    data, offsets = A.raw(texts)
    index = Exceptions(data)
    if unit == WORD:
        starts, at = word_starts(data, offsets)
        n = np.diff(at)
        places = np.append(starts, len(data))
        byte_of = lambda k: np.where(k == n, offsets[1:], places[at[:-1] + np.minimum(k, n)])
    else:
        begin = index.chars(offsets)
        n = np.diff(begin)
        byte_of = lambda k: index.bytes(begin[:-1] + k)
    one, two = first % (n + 1), second % (n + 1)
    low, high = byte_of(np.minimum(one, two)), byte_of(np.maximum(one, two))
    begin = index.chars(offsets[:-1])
    return n, low, high, index.chars(low) - begin, index.chars(high) - begin


def held(texts: pa.Array, markers: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(len(texts), bool)
    for m in markers:
        out |= np.asarray(pc.match_substring(texts, m))
    return out


def transformed(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points, null if plain), output of every row."""
    markers = (plan.prefix, plan.suffix, plan.middle)

    def transform(batches):
        p, s, m = (x.encode() for x in markers)
        for batch in batches:
            for part, texts in A.slices(batch):
                h = [np.asarray(A.column(part, f"h{k}"), np.int64) for k in range(1, 5)]
                n, low, high, low_char, high_char = cuts(texts, h[0], h[1], plan.unit)
                data, offsets = A.raw(texts)
                plain = (np.diff(offsets) == 0) | (h[2] % 100 >= plan.rate) | held(texts, markers)
                spm = h[3] % 100 < plan.spm
                whole, out = data.tobytes(), []
                for a, b, i, j, is_plain, is_spm in zip(offsets.tolist(), offsets[1:].tolist(), low.tolist(), high.tolist(), plain.tolist(), spm.tolist()):
                    if is_plain:
                        out.append(whole[a:b])
                    elif is_spm:
                        out.append(b"".join((s, whole[j:b], p, whole[a:i], m, whole[i:j])))
                    else:
                        out.append(b"".join((p, whole[a:i], s, whole[j:b], m, whole[i:j])))
                form = pa.array(np.where(plain, PLAIN, np.where(spm, SPM, PSM)).tolist(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [A.column(part, "doc_id"), pa.array(n, pa.int64()), form, pa.array(low_char, pa.int64(), mask=plain), pa.array(high_char - low_char, pa.int64(), mask=plain),
                     pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), *numbers, F.col(text_col).alias("text"))
    return own.mapInArrow(transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def put_together(output: str, form: str, plan: Plan) -> str:
    """The text that an output was made from."""
    if form == PLAIN:
        return output
    first, second = (plan.suffix, plan.prefix) if form == SPM else (plan.prefix, plan.suffix)
    a = output.index(first) + len(first)
    b = output.index(second, a)
    c = output.index(plan.middle, b + len(second))
    parts = output[a:b], output[b + len(second):c]
    prefix, suffix = reversed(parts) if form == SPM else parts
    return prefix + output[c + len(plan.middle):] + suffix


def restored(rows: DataFrame, plan: Plan = Plan(), output_col: str = "output", form_col: str = "form") -> DataFrame:
    """rows with `restored`: the exact text, from output and form alone."""
    columns = [c for c in rows.columns if c != "restored"]

    def restore(batches):
        for batch in batches:
            for part, outputs in A.slices(batch, output_col):
                texts = [put_together(o, f, plan) for o, f in zip(outputs.to_pylist(), A.column(part, form_col).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(A.column(part, c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "restored"])

    schema = rows.select(*columns).schema.add("restored", "string")
    return rows.select(*columns).mapInArrow(restore, schema)


def digests(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    rows = restored(transformed(docs, plan, id_col, text_col), plan)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
