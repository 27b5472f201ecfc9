"""Fill-in-middle against a brute-force version over code points, and exact round trips."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from edge_docs import ROWS

from citystream.llm import arrowtext, fim, queries

SF = "/root/testdata/sf0.001"
UNITS = {fim.WORD: r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", fim.CHAR: r"(?s:.)"}


def brute(doc_id, text, unit=fim.WORD, rate=50, spm=80):
    text = text or ""
    units = re.findall(UNITS[unit], text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_fim_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op11_fill_in_middle(spark, SF).collect()))
    assert got == sorted((*brute(r["doc_id"], r["text"])[:5], sha(brute(r["doc_id"], r["text"])[5]), sha(r["text"])) for r in docs)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


MORE = [(100 + i, t, None) for i, t in enumerate(["<P>", "a <S> b", "x<M", "<", "<P", "é" * 50 + " " + "😀 " * 40, "\x85\xa0   wide", "  lead", "trail \n", "x" * 3000, "中 文\t字" * 30, "<<P <S< >M>" * 5, "é z"])]


@pytest.mark.parametrize("unit", [fim.WORD, fim.CHAR])
def test_fim_of_odd_rows(spark, docs, none, unit):
    plan = fim.Plan(unit=unit, rate=100, spm=50)
    more = spark.createDataFrame(MORE * 9, "doc_id long, text string, lang string").selectExpr("doc_id * 31 + hash(uuid()) * 0 as doc_id", "text")
    for df, rows in ((docs, ROWS), (more, [(i * 31, t, x) for i, t, x in MORE * 9])):
        made = fim.transformed(df, plan)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, made.collect()), key=key) == sorted((brute(i, t, unit, 100, 50) for i, t, _ in rows), key=key)
        assert sorted(r["restored"] for r in fim.restored(made, plan).collect()) == sorted(t or "" for _, t, _ in rows)
    assert fim.digests(none, plan).count() == 0


def test_exceptions_convert_both_ways():
    rng = np.random.default_rng(3)
    for _ in range(20):
        text = "".join(rng.choice(list("ab é中😀\n")) for _ in range(int(rng.integers(0, 200))))
        data, _ = arrowtext.raw(pa.array([text]))
        index = fim.Exceptions(data)
        byte = np.asarray([len(text[:k].encode()) for k in range(len(text) + 1)])
        assert index.bytes(np.arange(len(text) + 1)).tolist() == byte.tolist()
        assert index.chars(byte).tolist() == list(range(len(text) + 1))
        assert len(index.byte) == sum(ord(c) > 127 for c in text)


def test_markers_must_tell_apart():
    for markers in (("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("ab", "bc", "x"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim.Plan(*markers)
