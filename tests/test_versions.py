import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logtally.sinks import versions
from tests.conftest import rows


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def test_a_failing_build_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1, 2), root)
    versions.point_view(spark, "versioned_view", root)
    broken = numbers(spark, 3).withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("lost"))).cast("long"))
    with pytest.raises(PySparkException):
        versions.replace_table(broken, root)
    assert rows(versions.read(spark, root)) == rows(spark.table("versioned_view")) == [(1,), (2,)]
    assert len(os.listdir(f"{root}/data")) == 1            # nothing of the failed one is left
    versions.replace_table(numbers(spark, 3), root)
    versions.point_view(spark, "versioned_view", root)
    assert rows(versions.read(spark, root)) == rows(spark.table("versioned_view")) == [(3,)]
    spark.sql("DROP VIEW versioned_view")


def test_the_old_version_is_read_until_it_is_dropped(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1), root)
    open_frame = versions.read(spark, root)
    versions.replace_table(versions.read(spark, root).union(numbers(spark, 2)), root)      # reads itself
    assert rows(open_frame) == [(1,)] and rows(versions.read(spark, root)) == [(1,), (2,)]
    assert versions.drop_old(spark, root, keep=2) == []
    assert len(versions.drop_old(spark, root, keep=1)) == 1
    assert rows(versions.read(spark, root)) == [(1,), (2,)] and len(os.listdir(f"{root}/data")) == 1


def test_parts_are_replaced_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    day = spark.createDataFrame([("a b/c", 1), ("2", 2), ("2", 3), ("3", 4)], "day string, n long")
    versions.replace_parts(day, root, "day", ["a b/c", "2", "3"])
    before = versions.parts(spark, root)
    new = spark.createDataFrame([("2", 20)], "day string, n long")
    versions.replace_parts(new, root, "day", ["2", "3"])                                   # nothing is left of 3
    assert rows(versions.read(spark, root)) == [("2", 20), ("a b/c", 1)]
    assert versions.parts(spark, root)["a b/c"] == before["a b/c"]
    assert rows(versions.read(spark, root, only=["2"])) == [("2", 20)]
    with pytest.raises(ValueError):
        versions.replace_parts(new, root, "day", ["3"])
    assert rows(versions.read(spark, root)) == [("2", 20), ("a b/c", 1)]
    versions.replace_parts(new.limit(0), root, "day", ["2", "a b/c"])
    empty = versions.read(spark, root)
    assert empty.columns == ["day", "n"] and empty.count() == 0


def test_parts_are_written_by_few_tasks_and_counted(spark, tmp_path):
    root, seen = str(tmp_path / "t"), Observation()
    rows_in = [(day, n) for day in ("1", "2") for n in range(20)]
    df = spark.createDataFrame(rows_in, "day string, n long").repartition(8)
    versions.replace_parts(df, root, "day", ["1", "2"], seen=seen)
    assert seen.get == {"rows": 40} and rows(versions.read(spark, root)) == sorted(rows_in, key=repr)
    for folder in versions.parts(spark, root).values():
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1       # not one per task of the frame


def test_each_part_is_replaced_by_rows_of_its_own(spark, tmp_path):
    root = str(tmp_path / "t")

    def of(**numbers_of):
        return lambda day: spark.createDataFrame([(day, n) for n in numbers_of[f"d{day}"]], "day string, n long")

    versions.replace_each(spark, root, of(d1=[1, 1, 2], d2=[3], d3=[4]), ["1", "2", "3"])
    assert rows(versions.read(spark, root)) == [("1", 1), ("1", 1), ("1", 2), ("2", 3), ("3", 4)]
    before, part = versions.parts(spark, root), versions.part_reader(spark, root)
    versions.replace_each(spark, root, of(d2=[], d3=[5]), ["2", "3"])                     # nothing is left of 2
    assert rows(versions.read(spark, root)) == [("1", 1), ("1", 1), ("1", 2), ("3", 5)]
    assert versions.parts(spark, root)["1"] == before["1"] and set(versions.parts(spark, root)) == {"1", "3"}
    assert rows(part("3")) == [("3", 4)]                                                  # as it was committed then
    after, held = versions.parts(spark, root), len(os.listdir(f"{root}/data"))
    lost = F.raise_error(F.lit("lost")).cast("long")

    def broken(day):
        return numbers(spark, 1).select(F.lit(day).alias("day"), (F.col("n") if day == "1" else lost).alias("n"))

    with pytest.raises(PySparkException):
        versions.replace_each(spark, root, broken, ["1", "3"])
    assert versions.parts(spark, root) == after and len(os.listdir(f"{root}/data")) == held


def test_writers_at_once_keep_each_others_parts(spark, tmp_path):
    root = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: versions.append(numbers(spark, k), root), range(8)))
    assert rows(versions.read(spark, root)) == [(k,) for k in range(8)]


def test_a_half_written_commit_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1), root)
    with open(f"{root}/_commits/{2:020d}", "w") as f:
        f.write(json.dumps({"parts": {"": "data/nowhere"}})[:12])
    assert rows(versions.read(spark, root)) == [(1,)]
    versions.append(numbers(spark, 5), root)
    assert rows(versions.read(spark, root)) == [(1,), (5,)]
    assert f"{3:020d}" in os.listdir(f"{root}/_commits")


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    numbers(spark, 4).write.parquet(str(tmp_path / "plain"))
    assert rows(versions.read(spark, str(tmp_path / "plain"))) == [(4,)]
    assert versions.folders(spark, str(tmp_path / "plain")) == [str(tmp_path / "plain")]
    assert versions.drop_old(spark, str(tmp_path / "plain")) == []
    for k in (1, 2):
        versions.append(numbers(spark, k), str(tmp_path / "t"))
    with pytest.raises(ValueError):
        versions.folder(spark, str(tmp_path / "t"))


def test_unfinished_folders_stay_until_they_are_old(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbers(spark, 1), root)
    running = versions.new_folder(root)             # of a write that goes on: no commit names it
    numbers(spark, 9).write.parquet(running)
    assert versions.drop_old(spark, root, keep=1) == []
    assert versions.drop_old(spark, root, keep=1, unfinished_s=-1) == [running.rsplit("/", 1)[1]]
    assert rows(versions.read(spark, root)) == [(1,)]
