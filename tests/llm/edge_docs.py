"""Documents with every odd case: nulls in any column, empty and very long texts,
ties, repeated rows, and extra columns whose names clash with internal ones."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rank long, bucket int, hashes string, "
          "_row string, _sha string, _n long, found string, length long, fp long, dim int, row string, line int, size long, copy long")

LONG = " ".join(f"w{i % 977} lorem{i % 13}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, "The cat sat on the mat.", "en"), (2, "the cat  sat on the mat.", "en"), (3, "The cat sat on the mat.\n", None),
    (4, "", "en"), (5, None, "fr"), (6, " \t\n\x0b\f\r", None), (None, "no id here", "de"), (None, None, None), (7, LONG, "en"), (8, LONG + " tail", "de"),
    (9, f"alpha {PASSAGE} omega", "en"), (10, f"beta {PASSAGE} psi {PASSAGE}", "en"), (10, f"beta {PASSAGE} psi {PASSAGE}", "en"),
    (11, "été où naïve 中文 😀 don't we'll  I'M <|endoftext|> ▁x", "fr"), (12, "12 345 ...", "es"), (13, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "en"),
    (14, "same", "en"), (14, "other text of the same id", "en"), (15, "nbsp and space\x85x", "fr"), (None, f"gamma {PASSAGE}", None),
]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, lang, None, None if t is None else len(t), 5, 5, "h", "r", "s", 5, "f", 5, 5, 5, "row", 5, 5, 5) for i, t, lang in ROWS], SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
