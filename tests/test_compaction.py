import os

import pytest

from logtally.sinks import versions
from logtally.streaming import compact_batches, read_event_counts, stream_event_counts, stream_tagged_lines
from logtally.streaming.compact import folded_root, settled_through
from tests.conftest import rows
from tests.fixtures import event, write_gz


def land(folder, names):
    for name in names:
        write_gz(folder / f"{name}.gz", [event("zoom"), event("zoom"), event(f"tts-{name}")])


def want(names):
    return sorted(r for n in names for r in [(f"{n}.gz", f"tts-{n}", 1), (f"{n}.gz", "zoom", 2)])


def counts(df):
    return sorted(tuple(r) for r in df.select("fileName", "name", "occurrenceCount").collect())


def folders(out):
    return sorted(n for n in os.listdir(out) if n.startswith("batch="))


def run(spark, root, out, **options):
    stream_event_counts(spark, str(root), "clean/", "$.name", out, max_files_per_trigger=1, **options).awaitTermination()


def test_folded_batches_are_read_once_and_the_stream_goes_on(spark, tmp_path):
    root, out = tmp_path / "nom" / "clean", str(tmp_path / "counts")
    land(root, "abc")
    run(spark, root, out)
    assert compact_batches(spark, str(tmp_path / "nothing")) == []
    began = read_event_counts(spark, out)
    before = rows(began)
    assert compact_batches(spark, out) == [0, 1, 2]
    assert rows(read_event_counts(spark, out)) == before and counts(began) == want("abc")
    assert folders(out) == ["batch=0", "batch=1", "batch=2"]           # for readers like ``began``
    assert compact_batches(spark, out) == [] and folders(out) == []
    assert rows(read_event_counts(spark, out)) == before

    land(root, "de")                                                   # a restart
    run(spark, root, out)
    assert counts(read_event_counts(spark, out)) == want("abcde")
    assert compact_batches(spark, out) == [3, 4]
    assert list(versions.parts(spark, folded_root(out))) == ["0-4"]    # the small last part joined in
    assert counts(read_event_counts(spark, out)) == want("abcde")
    assert rows(read_event_counts(spark, out).select("batch").distinct()) == [(i,) for i in range(5)]


def test_files_are_near_the_target(spark, tmp_path):
    root, out = tmp_path / "nom" / "clean", str(tmp_path / "counts")
    land(root, "abcdef")
    run(spark, root, out)
    total = sum(versions.size(spark, f"{out}/{f}") for f in folders(out))
    compact_batches(spark, out, target_bytes=-(-total // 2))
    (part,) = versions.parts(spark, folded_root(out)).values()
    assert len([n for n in os.listdir(part) if n.endswith(".parquet")]) == 2
    land(root, "gh")
    run(spark, root, out)
    compact_batches(spark, out, target_bytes=1)                        # a full part stays as it is
    assert sorted(versions.parts(spark, folded_root(out))) == ["0-5", "6-7"]
    assert counts(read_event_counts(spark, out)) == want("abcdefgh")


def test_a_batch_that_may_run_again_is_not_folded(spark, tmp_path):
    root, out, ckpt = tmp_path / "nom" / "clean", str(tmp_path / "counts"), str(tmp_path / "ckpt")
    land(root, "abc")
    run(spark, root, out, checkpoint_location=ckpt)
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    assert settled_through(spark, out) == 1
    assert compact_batches(spark, out) == [0, 1]
    assert counts(read_event_counts(spark, out)) == want("abc")
    run(spark, root, out, checkpoint_location=ckpt)                    # batch 2 runs again
    assert counts(read_event_counts(spark, out)) == want("abc")
    assert compact_batches(spark, out) == [2] and counts(read_event_counts(spark, out)) == want("abc")


def test_a_failing_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "nom" / "clean", str(tmp_path / "counts")
    land(root, "ab")
    run(spark, root, out)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "create", lost)
        with pytest.raises(OSError):
            compact_batches(spark, out)
    assert counts(read_event_counts(spark, out)) == want("ab")
    assert compact_batches(spark, out) == [0, 1] and counts(read_event_counts(spark, out)) == want("ab")


def test_an_output_keeps_its_checkpoint(spark, tmp_path):
    root, one, two = tmp_path / "nom" / "clean", str(tmp_path / "one"), str(tmp_path / "two")
    land(root, "a")
    run(spark, root, one, checkpoint_location=str(tmp_path / "c1"))
    land(root, "b")
    run(spark, root, one)                                              # the noted one is used
    assert counts(read_event_counts(spark, one)) == want("ab")
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, root, one, checkpoint_location=str(tmp_path / "c2"))
    stream_tagged_lines(spark, str(root), "clean/", two).awaitTermination()
    with pytest.raises(ValueError, match="checkpoint"):                # also beside the default one
        stream_tagged_lines(spark, str(root), "clean/", two, str(tmp_path / "c3"))
    assert spark.read.parquet(two).count() == 6
