import json
import os
import subprocess
import sys

import pytest

import logtally.plans.incremental as refresh_plan
from logtally.plans.incremental import archive_day, refresh
from logtally.plans.setup import EVENT_COUNTS_SCHEMA, SetupConfig, run_setup
from logtally.sinks import read_delimited, versions
from logtally.sources.landing import check_new, read_manifest
from tests.conftest import rows
from tests.fixtures import event, write_gz

META = {"locations": ["l1", "l2"], "pseudoEvents": ["p"], "ua": {"groups": ["g"]}}


def land(base, day, name, n=3, file="a"):
    write_gz(base / "raw" / "metrics" / f"{day}_{file}.gz", ['{"clientData":{"name":"%s"}}' % name] * n)
    write_gz(base / "nom" / "clean" / f"{day}_{file}.gz", [event(name, meta=META)] * n)


def config(base, out):
    return SetupConfig(raw_root=str(base / "raw" / "metrics"), clean_root=str(base / "nom" / "clean"), output_root=str(out))


def same_tables(spark, cfg, full):
    """The tables of a refresh hold the rows of a full run."""
    for side, name in (("raw", "lines"), ("clean", "lines"), ("raw", "file_meta"), ("clean", "file_meta"), ("raw", "event_counts"),
                       ("clean", "events"), ("report", "dimensions"), ("report", "reconcile"), ("report", "left_reconcile")):
        got = versions.read(spark, cfg.path(side, name)).drop("archiveDay")
        want = versions.read(spark, full.path(side, name)).select(got.columns)
        assert rows(got) == rows(want), (side, name)
    text = read_delimited(spark, versions.folder(spark, full.path("clean", "event_counts")), EVENT_COUNTS_SCHEMA, escape=True)
    assert rows(versions.read(spark, cfg.path("clean", "event_counts"))) == rows(text)


def test_one_more_day_rewrites_that_day_only(spark, tmp_path):
    base, out = tmp_path / "land", tmp_path / "out"
    land(base, "2024-01-01", "zoom")
    land(base, "2024-01-02", "scroll")
    write_gz(base / "raw" / "metrics" / "undated.gz", ["plain line"])
    cfg = config(base, out)
    first = refresh(spark, cfg)
    assert first["raw"] == {"opened": 3, "held_back": 0, "days": ["2024-01-01", "2024-01-02", "none"]}
    before = versions.parts(spark, cfg.path("clean", "events"))
    land(base, "2024-01-03", "click")
    land(base, "2024-01-02", "more", file="b")
    second = refresh(spark, cfg)
    assert second["clean"] == {"opened": 2, "held_back": 0, "days": ["2024-01-02", "2024-01-03"]}
    after = versions.parts(spark, cfg.path("clean", "events"))
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-01-02"] != before["2024-01-02"]
    full = config(base, tmp_path / "full")
    run_setup(spark, full)
    same_tables(spark, cfg, full)
    assert refresh(spark, cfg)["clean"] == {"opened": 0, "held_back": 0, "days": []}      # nothing to do


def test_changed_refused_and_removed_archives(spark, tmp_path):
    base, out = tmp_path / "land", tmp_path / "out"
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        land(base, day, "zoom")
    cfg = config(base, out)
    refresh(spark, cfg)
    land(base, "2024-01-01", "other", n=5)                            # replaced by a longer one
    for side in ("raw/metrics", "nom/clean"):
        os.remove(base / side / "2024-01-02_a.gz")
        good = (base / side / "2024-01-03_a.gz").read_bytes()
        (base / side / "2024-01-03_a.gz").write_bytes(good[:len(good) // 2])
    done = refresh(spark, cfg)
    assert done["raw"]["opened"] == 2 and done["raw"]["days"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert {r["reason"] for r in read_manifest(spark, cfg.path("raw", "landing_manifest")).collect()} == {"ok", "truncated"}
    lines = versions.read(spark, cfg.path("raw", "lines"))
    assert {(r["archiveDay"], r["name"]) for r in lines.collect()} == {("2024-01-01", "other")} and lines.count() == 5
    full = config(base, tmp_path / "full")
    full.validate = True
    run_setup(spark, full)
    same_tables(spark, cfg, full)


def test_a_refresh_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    base, out = tmp_path / "land", tmp_path / "out"
    land(base, "2024-01-01", "zoom")
    cfg = config(base, out)
    refresh(spark, cfg)
    before = rows(versions.read(spark, cfg.path("report", "dimensions")))
    land(base, "2024-01-02", "scroll")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(refresh_plan, "_rewrite_events", lost)
        with pytest.raises(RuntimeError):
            refresh(spark, cfg)
    assert rows(versions.read(spark, cfg.path("report", "dimensions"))) == before
    assert refresh(spark, cfg)["clean"]["days"] == ["2024-01-02"]
    full = config(base, tmp_path / "full")
    run_setup(spark, full)
    same_tables(spark, cfg, full)


def test_a_second_check_opens_only_what_is_new(spark, tmp_path):
    root, store = tmp_path / "land", str(tmp_path / "manifest")
    for k in range(3):
        write_gz(root / f"{k}.gz", ["x"])
    first = check_new(spark, str(root), store)
    assert first.opened == 3 and read_manifest(spark, store).count() == 0
    first.commit()
    write_gz(root / "new.gz", ["y"])
    (root / "1.gz").write_bytes(b"no archive")
    os.utime(root / "2.gz", (os.path.getatime(root / "2.gz"), 1_000_000_000))            # same length, another time
    second = check_new(spark, str(root), store)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in second.rows.collect()) == ["1.gz", "2.gz", "new.gz"]
    second.commit()
    assert sorted((r["path"].rsplit("/", 1)[1], r["reason"]) for r in read_manifest(spark, store).collect()) == [
        ("0.gz", "ok"), ("1.gz", "not-gzip"), ("2.gz", "ok"), ("new.gz", "ok")]
    ahead = root / "ahead.gz"
    write_gz(ahead, ["z"])
    os.utime(ahead, (4_000_000_000, 4_000_000_000))                                       # a storage clock ahead of ours
    third = check_new(spark, str(root), store)
    assert (third.opened, third.held_back) == (0, 1)
    third.commit()
    assert len(versions.parts(spark, store)) == 2                                         # nothing new, no part


def test_many_increments_become_one(spark, tmp_path, monkeypatch):
    import logtally.sources.landing as landing
    monkeypatch.setattr(landing, "MOST_INCREMENTS", 2)
    root, store = tmp_path / "land", str(tmp_path / "manifest")
    for k in range(4):
        write_gz(root / f"{k}.gz", ["x"])
        check_new(spark, str(root), store).commit()
    assert len(versions.parts(spark, store)) <= 2
    assert read_manifest(spark, store).count() == 4


def test_day_of_an_archive(spark):
    df = spark.createDataFrame([("s3://a/day=2024-02-03/x.gz",), ("/l/x-2023-12-31-2024-01-01.gz",), ("/l/x.gz",)], "path string")
    assert [r[0] for r in df.select(archive_day("path")).collect()] == ["2024-02-03", "2023-12-31", "none"]


def test_tasks_hold_no_dimension_rows(tmp_path):
    many = {"locations": [f"l{i}" for i in range(20)], "pseudoEvents": [f"p{i}" for i in range(20)],
            "ua": {"groups": [f"g{i}" for i in range(20)]}}
    for day in ("2024-01-01", "2024-01-02"):
        write_gz(tmp_path / "raw" / "metrics" / f"{day}.gz", ['{"clientData":{"name":"zoom"}}'] * 15)
        write_gz(tmp_path / "nom" / "clean" / f"{day}.gz", [event("zoom", meta=many)] * 15)
    (tmp_path / "log").mkdir()
    proc = subprocess.run([sys.executable, os.path.join(os.path.dirname(os.path.abspath(__file__)), "refresh_job.py"),
                           str(tmp_path), str(tmp_path / "out"), str(tmp_path / "log")], capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    assert got["rows"] == 2 * 15 * 20 ** 3
    assert got["mb"] < 20              # the rows of a day are more
