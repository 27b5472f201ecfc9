"""What tasks hold at once."""

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from citystream import session
from citystream.llm import bytebpe
from citystream.streaming import jobs, stateful


def test_pipeline_stages_send_arrow_batches_of_bounded_bytes(spark):
    rows = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('words ', 1000) AS text", "'en' AS lang", "'s' AS source", "6000 AS n_chars")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    assert session.ARROW_BYTES_CONF not in spark.conf.getAll
    for stage in (corpus_pipeline.language_identification, corpus_pipeline.simhash_near_dedup, corpus_pipeline.substring_deduplication, corpus_pipeline.best_fit_packing):
        try:
            stage(spark, rows.limit(3), "")
            got = rows.mapInArrow(sizes, "n long, bytes long").collect()
        finally:
            spark.conf.unset(session.ARROW_BYTES_CONF)
        assert sum(r["n"] for r in got) == 3000
        assert max(r["bytes"] for r in got) < 1.1 * session.BATCH_BYTES, stage.__name__


def test_a_bound_that_the_session_sets_stays(spark):
    spark.conf.set(session.ARROW_BYTES_CONF, "1m")
    try:
        session.bounded_batches(spark)
        assert spark.conf.get(session.ARROW_BYTES_CONF) == "1m"
    finally:
        spark.conf.unset(session.ARROW_BYTES_CONF)


def test_remembered_ids_are_no_number_objects():
    encoder = bytebpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = pa.array(["unquestionable flibbertigibbets", "", "flibbertigibbets 12345678901234567890"])
    ids, ends = encoder.ids(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == encoder.encode(texts.to_pylist())
    assert encoder.seen and all(isinstance(v, bytes) for v in encoder.seen.values())


def test_state_stores_share_bounded_memory(spark):
    bounded, most = (f"spark.sql.streaming.stateStore.rocksdb.{c}" for c in ("boundedMemoryUsage", "maxMemoryUsageMB"))
    with jobs._rocksdb_state(spark):
        assert (spark.conf.get(bounded), spark.conf.get(most)) == ("true", str(jobs.STATE_MB))
    assert not {bounded, most, jobs.STATE_PROVIDER_CONF} & set(spark.conf.getAll)
    spark.conf.set(bounded, "false")
    try:
        with jobs._rocksdb_state(spark):
            assert spark.conf.get(bounded) == "false"
        assert spark.conf.get(bounded) == "false"
    finally:
        spark.conf.unset(bounded)


def test_pair_fold_keeps_no_columns_of_alerts():
    assert not {"bus_1", "bus_2", "route_id", "bucket"} & set(stateful.TOLD)
