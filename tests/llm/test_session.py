from graphloom.llm.session import BATCH_BYTES, FILE_ROWS, bounded_batches, checkpointed, on_core

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_but_never_widened(spark):
    before = spark.conf.get(KEY)
    try:
        for given, wanted in (("64MB", BATCH_BYTES), ("8m", "8m"), ("1g", BATCH_BYTES), (str(BATCH_BYTES), BATCH_BYTES), ("1024", "1024")):
            spark.conf.set(KEY, given)
            bounded_batches(spark)
            assert spark.conf.get(KEY) == str(wanted)
    finally:
        spark.conf.set(KEY, before)


def test_other_columns_are_packed_away(spark):
    docs = spark.createDataFrame([(1, "a", "x", 5)], "doc_id long, text string, `odd.name` string, _others int")
    seen = []
    out = on_core(docs, lambda core: seen.append(core.columns) or core)
    assert seen == [["doc_id", "text", "_others"]] and out.columns == docs.columns
    assert out.collect() == docs.collect()
    plain = docs.select("doc_id", "text")
    assert on_core(plain, lambda core: core) is plain


def test_few_rows_go_to_few_checkpoint_files(spark):
    rows = spark.range(100).repartition(8)
    wanted = sorted(rows.collect())
    for told, files in ((None, 8), (0, 1), (100, 1), (FILE_ROWS + 1, 2), (100 * FILE_ROWS, 8)):
        kept = checkpointed(rows, told)
        assert kept.rdd.getNumPartitions() == files and sorted(kept.collect()) == wanted
