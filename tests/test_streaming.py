from logtally.streaming.ingest import stream_event_counts, stream_tagged_lines
from tests.conftest import rows
from tests.fixtures import event, write_gz


def test_stream_picks_up_only_new_archives(spark, tmp_path):
    land = tmp_path / "nom" / "clean"
    out, ckpt = str(tmp_path / "tagged"), str(tmp_path / "ckpt")
    write_gz(land / "d1.gz", [event("zoom"), event("tts")])
    stream_tagged_lines(spark, str(land), "clean/", out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2

    write_gz(land / "d2.gz", [event("zoom")])
    write_gz(land / "d3-tmp.gz", [event("partial")])      # still being written
    stream_tagged_lines(spark, str(land), "clean/", out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got.groupBy("fileName").count()) == [("d1.gz", 2), ("d2.gz", 1)]


def test_stream_event_counts_state(spark, tmp_path):
    land = tmp_path / "nom" / "clean"
    out, ckpt = str(tmp_path / "counts"), str(tmp_path / "ckpt2")
    write_gz(land / "d1.gz", [event("zoom"), event("zoom"), ""])
    stream_event_counts(spark, str(land), "clean/", "$.name", out, ckpt).awaitTermination()
    write_gz(land / "d2.gz", [event("tts")])
    stream_event_counts(spark, str(land), "clean/", "$.name", out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got.drop("batch")) == [("d1.gz", "zoom", 2), ("d1.gz", None, 1),
                                       ("d2.gz", "tts", 1)]
    assert rows(got.select("batch").distinct()) == [(0,), (1,)]   # one folder per batch


def test_replayed_batch_counts_once(spark, tmp_path):
    import os
    land = tmp_path / "nom" / "clean"
    out, ckpt = str(tmp_path / "counts"), str(tmp_path / "ckpt3")
    write_gz(land / "d1.gz", [event("zoom"), event("zoom")])
    stream_event_counts(spark, str(land), "clean/", "$.name", out, ckpt).awaitTermination()
    # A crash after the batch wrote its output but before Spark recorded the
    # batch as committed: on restart the batch runs again.
    for name in ("0", ".0.crc"):                     # the marker and its checksum file
        path = os.path.join(ckpt, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    stream_event_counts(spark, str(land), "clean/", "$.name", out, ckpt).awaitTermination()
    assert os.path.exists(os.path.join(ckpt, "commits", "0"))      # batch 0 did run again
    assert rows(spark.read.parquet(out).drop("batch")) == [("d1.gz", "zoom", 2)]


def test_default_checkpoints_belong_to_their_outputs(spark, tmp_path):
    """A restart over the same output finds the second archive; two roots run
    by default side by side."""
    land, other = tmp_path / "nom" / "clean", tmp_path / "raw" / "metrics"
    lines, counts, second = (str(tmp_path / n) for n in ("lines", "counts", "second"))
    write_gz(land / "a.gz", [event("zoom")])
    write_gz(other / "r.gz", [event("tts")])
    for _ in range(2):
        stream_tagged_lines(spark, str(land), "clean/", lines).awaitTermination()
        stream_event_counts(spark, str(land), "clean/", "$.name", counts).awaitTermination()
        stream_event_counts(spark, str(other), "metrics/", "$.name", second).awaitTermination()
        write_gz(land / "b.gz", [event("zoom"), event("tts")])
    assert rows(spark.read.parquet(lines).groupBy("fileName").count()) == [("a.gz", 1), ("b.gz", 2)]
    assert rows(spark.read.parquet(counts).drop("batch")) == [("a.gz", "zoom", 1), ("b.gz", "tts", 1), ("b.gz", "zoom", 1)]
    assert rows(spark.read.parquet(second).drop("batch")) == [("r.gz", "tts", 1)]
