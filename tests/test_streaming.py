from stemma.streaming.changes import stream_changes, upsert_batch

SCHEMA = "doc_path string, change_op string, seq long, committed_ts string"


def test_feed_in_parts_equals_the_whole_and_resumes(spark, tmp_path):
    feed, folder = str(tmp_path / "feed"), str(tmp_path / "work")
    add = lambda rows: spark.createDataFrame([(*r, None) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    add([("a", "added", 1), ("b", "added", 2), ("a", "modified", 5), ("a", "modified", 5)])
    state = lambda: sorted(map(tuple, stream_changes(spark, feed, folder).collect()))
    assert state() == [("a", "modified", 5), ("b", "added", 2)]
    assert state() == [("a", "modified", 5), ("b", "added", 2)]  # nothing new
    add([("b", "removed", 7), ("a", "modified", 3), ("c", "added", 6)])  # one of them late
    assert state() == [("a", "modified", 5), ("b", "removed", 7), ("c", "added", 6)]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    write = upsert_batch(str(tmp_path / "state"))
    first, second = (spark.createDataFrame([r], SCHEMA) for r in (("a", "added", 1, None), ("a", "removed", 2, None)))
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "state/v1")).collect()] == [("a", "removed", 2)]


def test_empty_feed(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "feed"))
    assert stream_changes(spark, str(tmp_path / "feed")).count() == 0
