"""Language ID (operator 7): a byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length windows,
each filter keeps its maximum in the window (max pooling), and a softmax layer
gives the languages' probabilities. The network is trained in numpy on the
driver, on a bounded sample of labelled rows (at most SAMPLE_DOCS documents per
language, SAMPLE_WINDOWS windows of each); a few tens of kilobytes of weights
go to the tasks. Prediction reads every byte of every text: the text is laid
out in overlapping windows, so that each run of bytes that a filter can see is
in one, and a document's probabilities are the mean over its windows, weighted
by their bytes. There is no shuffle.

Softmax alone must choose a language, so the network has one class more, for text
in no learnt language: it is trained on made-up windows of symbols, digits and stray letters,
and of letters of other scripts. It never is a prediction. `identified` rejects a document
by that class' probability: the limit is the one that KEPT of the labelled windows that
training did not see (whole, and cut to a few words) stay under, so it does not
depend on how many languages there are.

Defined results: a null text, or one without a letter, is `und` with score 0; a
null language is no label; a null id is never learnt from and not held out;
repeated rows get equal predictions; ties go to the language that sorts first;
without any labelled row every text is `und`; an empty table gives an empty
result; other columns are ignored by `predictions` and carried by `identified`.
Very long texts are read whole, in batches of bounded size."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A

UNKNOWN = "und"

#: Bound of the training sample: documents of each language, windows of each document.
SAMPLE_DOCS = 512
SAMPLE_WINDOWS = 4

WINDOW = 256  # bytes
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EPOCHS = 5
#: Share of the sampled windows left for the limit, and of those that it must keep.
LEFT_OUT = 0.1
KEPT = 0.999
#: Made-up windows of no language, for each class of languages' average window.
NOISE = 1.0  # (and 1024 at least)
AT_ONCE = 256  # windows

#: Documents of this remainder of crc32(id) are held out of training.
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(lang, text of a window) of a bounded, repeatable choice of labelled rows.

    Of each language SAMPLE_DOCS buckets of the id's hash each give the document
    with the least hash: a hash aggregate over two numbers and the language.
    Only the chosen documents' texts are read, and only their windows are sent."""
    labelled = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    labelled = labelled.filter(F.col("lang").isNotNull() & (fold(F.col("id")) != HELD_OUT)).withColumn("h", F.xxhash64("id"))
    chosen = labelled.groupBy("lang", F.pmod("h", F.lit(SAMPLE_DOCS)).alias("b")).agg(F.min("h").alias("h")).select("lang", "h")
    # at most SAMPLE_DOCS rows for each class of the network, so they go to the texts
    texts = labelled.join(F.broadcast(chosen), ["lang", "h"], "left_semi")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0))
    windows = F.array(*[F.substring("text", (F.floor(room * k / max(1, SAMPLE_WINDOWS - 1)) + 1).cast("int"), F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)])
    rows = texts.select("lang", "h", F.explode(F.array_distinct(windows)).alias("w")).filter("w rlike '\\\\p{L}'").distinct().collect()
    return sorted((r["lang"], r["w"]) for r in rows)


def noise(rng: np.random.Generator, many: int) -> list[str]:
    """Texts in no language: symbols and digits with stray letters, and letters of a random script."""
    out = []
    signs, letters = "0123456789#+-=|/*_.:;<>()[]{}~^%$&@!?", "abcdefghijklmnopqrstuvwxyz"
    # blocks of letters: Greek to Georgian, Ethiopic to Khmer, kana and ideographs, Hangul
    blocks = [(0x370, 0x10FF), (0x1200, 0x17FF), (0x3041, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)]
    for _ in range(many):
        size, words = int(rng.integers(1, 40)), []
        if rng.random() < 0.5:
            stray = rng.random() * 0.3
            for _ in range(size):
                chars = rng.choice(list(letters if rng.random() < stray else signs), int(rng.integers(1, 3)) if rng.random() < stray else int(rng.integers(1, 7)))
                words.append("".join(chars))
            if rng.random() < 0.3:  # a letter or two alone
                words = ["".join(rng.choice(list(letters), int(rng.integers(1, 2))))]
        else:
            low, high = blocks[int(rng.integers(len(blocks)))]
            start = int(rng.integers(low, high))
            span = int(rng.integers(20, 200))
            for _ in range(size):
                words.append("".join(map(chr, np.minimum(start + rng.integers(0, span, int(rng.integers(1, 9))), high))))
        out.append(" ".join(words))
    return out


def shortened(rng: np.random.Generator, labelled: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(lang, a few words) of texts; words that are letters for less than a half (numbers, addresses)
    tell no language and are left out."""
    out = []
    for lang, text in labelled:
        words = text.split()
        n = int(rng.integers(1, 12))
        at = int(rng.integers(max(1, len(words) - n)))
        cut = " ".join(words[at:at + n])
        if 2 * sum(c.isalpha() for c in cut) >= max(2, len(cut)):
            out.append((lang, cut))
    return out


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]  # the network has one class more, for none of them
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # max width * EMBED x filters; rows beyond a filter's width are zero
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    limit: float = 1.0  # probability of no language up to which a text is kept

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter in each window (rows of bytes) and where it is."""
        span = self.filters.shape[0]
        x = self.embed[windows].reshape(len(windows), -1)
        seen = np.lib.stride_tricks.sliding_window_view(x, span, axis=1)[:, ::EMBED]
        z = np.ascontiguousarray(seen).reshape(-1, span) @ self.filters
        z = z.reshape(len(windows), -1, z.shape[1])
        return z.max(axis=1), z

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(windows)
        s = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts laid end to end: start, bytes and text of each. Windows
    of one text overlap by the widest filter less one."""
    sizes = np.diff(offsets)
    step = WINDOW - (max(WIDTHS) - 1)
    many = np.maximum(1, -(-(sizes - (max(WIDTHS) - 1)) // step))
    text = np.repeat(np.arange(len(sizes)), many)
    start = A.ragged(np.zeros(len(sizes), np.int64), many) * step
    return offsets[text] + start, np.minimum(WINDOW, sizes[text] - start), text


def cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The windows' bytes, filled up with zeros."""
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0) if len(data) else np.zeros((len(start), WINDOW), np.uint8)


def bytes_of(texts: list[str]) -> np.ndarray:
    x = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "replace")[:WINDOW]
        x[i, :len(b)] = np.frombuffer(b, np.uint8)
    return x


def gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean weighted cross entropy; they flow through each filter's maximum only. `used`
    masks the filters' rows beyond their widths."""
    span, n = net.filters.shape
    top, z = net.pooled(x)
    place = z.argmax(axis=1)  # of each window and filter
    hidden = np.maximum(top + net.bias, 0)
    s = hidden @ net.out + net.out_bias
    e = np.exp(s - s.max(axis=1, keepdims=True))
    ds = e / e.sum(axis=1, keepdims=True)
    ds[np.arange(len(x)), y] -= 1
    ds *= (weight / len(x))[:, None]
    dh = (ds @ net.out.T) * (hidden > 0)
    near = np.minimum(place[:, :, None] + np.arange(max(WIDTHS)), WINDOW - 1)
    seen_bytes = x[np.arange(len(x))[:, None, None], near]  # window, filter, position
    seen = net.embed[seen_bytes].reshape(len(x), n, span)
    dembed = np.zeros_like(net.embed)
    np.add.at(dembed, seen_bytes.reshape(-1), (dh[:, :, None] * net.filters.T[None]).reshape(-1, EMBED))
    return {"embed": dembed, "filters": np.einsum("bf,bfs->sf", dh, seen) * used, "bias": dh.sum(axis=0), "out": hidden.T @ ds, "out_bias": ds.sum(axis=0)}


def started(languages: tuple[str, ...], rng: np.random.Generator) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights before training, and the mask of the filters' rows."""
    span, n = max(WIDTHS) * EMBED, FILTERS * len(WIDTHS)
    used = np.zeros((span, n), np.float32)
    for k, w in enumerate(WIDTHS):
        used[:w * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 1 / np.sqrt(span), (span, n)) * used, "bias": np.zeros(n),
         "out": rng.normal(0, 1 / np.sqrt(n), (n, len(languages) + 1)), "out_bias": np.zeros(len(languages) + 1)}
    return {k: v.astype(np.float32) for k, v in p.items()}, used


def train(labelled: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """Adam on the cross entropy; the limit of the class of no language from windows left out."""
    languages = tuple(sorted({lang for lang, _ in labelled}))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    away = rng.random(len(labelled)) < LEFT_OUT
    if away.all():
        away[:] = False
    seen, unseen = [r for r, a in zip(labelled, away) if not a], [r for r, a in zip(labelled, away) if a]
    seen += shortened(rng, seen[::2])
    strange = noise(rng, max(1024, int(NOISE * len(seen) / len(languages))))
    x = bytes_of([w for _, w in seen] + strange)
    y = np.asarray([languages.index(lang) for lang, _ in seen] + [len(languages)] * len(strange))
    classes = np.bincount(y, minlength=len(languages) + 1)
    weight = (len(y) / len(classes) / np.maximum(classes, 1))[y].astype(np.float32)

    p, used = started(languages, rng)
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            t += 1
            for k, g in gradients(Network(languages, **p), x[rows], y[rows], weight[rows], used).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] = (p[k] - 0.004 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    net = Network(languages, **p)
    texts = [t for _, t in unseen + shortened(rng, unseen)]
    if not texts:
        return net
    _, _, none = label(net, pa.array(texts, pa.string()))
    return replace(net, limit=float(np.quantile(none, KEPT)))


def label(network: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score, and probability of no learnt language of each null-free text."""
    spoken = np.asarray(pc.match_substring_regex(texts, r"\p{L}")) if len(texts) else np.zeros(0, bool)
    if network is None or not len(texts):
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
    data, offsets = A.raw(texts)
    start, size, text = layout(data, offsets)
    sums = np.zeros((len(texts), len(network.languages) + 1))
    for at in range(0, len(start), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        share = network.probabilities(cut(data, start[part], size[part])) * np.maximum(size[part], 0)[:, None]
        np.add.at(sums, text[part], share)
    mean = sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)
    best = mean[:, :-1].argmax(axis=1)
    names = [network.languages[b] if s else UNKNOWN for b, s in zip(best, spoken)]
    return names, np.where(spoken, np.clip(mean[np.arange(len(best)), best], 0, 1), 0), np.where(spoken, mean[:, -1], 1)


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    return train(sample(docs, id_col, text_col, lang_col))


def predictions(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""

    def predict(batches):
        for batch in batches:
            for part, texts in A.slices(batch):
                names, score, _ = label(network, texts)
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), A.column(part, "held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(F.col(id_col)) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return own.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """Rows in a learnt language, with all columns of docs."""

    def keep(batches):
        for batch in batches:
            for part, texts in A.slices(batch, text_col):
                names, _, none = label(network, texts)
                stays = pa.array([n != UNKNOWN and p <= network.limit for n, p in zip(names, none)], pa.bool_())
                yield part.filter(stays)

    return docs.mapInArrow(keep, docs.schema)
