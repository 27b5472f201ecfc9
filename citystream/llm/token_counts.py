"""Token counts (operator 5): the whole-token shortcut.

Offline, on the driver, every string of the vocabulary is encoded alone; those
that come out as exactly one token are proven whole. In the corpus a pre-token
that is proven whole counts one without merging, only the rest is merged (once
per distinct pre-token of a task's memory). The table of proven strings has at
most one entry per vocabulary id, so shipping it to the tasks is bounded by the
tokenizer file, not by the data. There is no shuffle.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a null id
column is carried as it is; repeated rows each give their own row; an empty
table gives an empty result; other columns are ignored. Special strings inside
texts are handled as the tokenizer does by default. Very long texts are counted
whole (memory of a task follows its longest text)."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm import arrowtext as A
from citystream.llm import bytebpe


def proven_whole(path: str) -> pa.Array:
    """Strings of the vocabulary that encode alone as one token, proven by encoding each."""
    tokenizer = bytebpe.load(path)
    if not bytebpe.by_words(path):
        return pa.array([], pa.string())
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = [i for s, i in tokenizer.get_vocab(with_added_tokens=False).items() if s not in special]
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in ids]
    alone = tokenizer.encode_batch(texts, add_special_tokens=False)
    return pa.array(sorted(t for t, i, e in zip(texts, ids, alone) if e.ids == [i]), pa.string())


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than `limit` tokens) of each row."""
    whole = docs.sparkSession.sparkContext.broadcast(proven_whole(tokenizer_path))

    def count(batches):
        encoder = bytebpe.Encoder(tokenizer_path, whole.value)
        for batch in batches:
            for part, texts in A.slices(batch):
                n = pa.array(encoder.counts(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([A.column(part, "doc_id"), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
