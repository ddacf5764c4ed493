"""Loads can be repeated, resumed and fail without losing or doubling rows."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.projection import next_version
from millrace.quality import reconcile, write_logged
from millrace.session import shared_folder
from millrace.sources import writers
from millrace.sources.incremental import backfill, existing, file_mark, load_files_once, load_new_files, load_past_mark, past_mark
from millrace.sources.readers import (
    files_by_date,
    jdbc_options,
    list_files,
    load_manifest,
    read_chosen,
    read_csv,
    read_manifest,
    read_parts,
)
from millrace.sources.writers import (
    delete_insert_by_key,
    full_refresh,
    list_versions,
    read_version,
    replace_partitions,
    upsert_by_key,
    write_daily,
    write_files,
    write_format,
)

from .conftest import rows


def ts(text):
    return dt.datetime.fromisoformat(text)


def table(spark, *data):
    return spark.createDataFrame(list(data), "id int, ts timestamp_ntz, v string")


def test_existing_only_hides_a_missing_path(spark, folder):
    assert existing(spark, f"{folder}/none") is None
    spark.range(1).selectExpr("'x' AS value").write.text(f"{folder}/text")
    with pytest.raises(Exception, match="not a Parquet file"):
        existing(spark, f"{folder}/text")


def test_mark_keeps_late_rows_of_the_same_time(spark, folder):
    first = table(spark, (1, ts("2024-01-01T10:00:00.000001"), "a"), (2, ts("2024-01-01T10:00:00.000002"), "b"))
    more = first.unionByName(table(spark, (3, ts("2024-01-01T10:00:00.000002"), "c"), (4, ts("2024-01-02"), "d")))
    load_past_mark(first, folder, "ts", ["id"])
    for _ in range(3):
        load_past_mark(more, folder, "ts", ["id"])
    assert [r.id for r in spark.read.parquet(folder).orderBy("id").collect()] == [1, 2, 3, 4]
    assert past_mark(more, spark.read.parquet(folder), "ts", ["id"]).count() == 0


def test_file_mark_moves_only_after_success(spark, folder):
    source, state = f"{folder}/in", f"{folder}/state"
    spark.range(3).write.parquet(source)
    seen = []

    def failing(paths):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError):
        load_new_files(spark, source, state, "s", failing)
    assert file_mark(spark, state, "s") is None
    assert load_new_files(spark, source, state, "s", seen.extend) == len(seen) > 0
    newest = list_files(spark, source, ext=".parquet").agg(F.max("modified").cast("string")).first()[0]
    assert file_mark(spark, state, "s") == newest
    assert load_new_files(spark, source, state, "s", seen.extend) == 0
    assert load_new_files(spark, source, state, "other", lambda p: None) > 0


def test_files_are_loaded_once_when_a_load_ends_before_its_mark(spark, folder):
    source, out, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    schema = "id bigint, v string"

    def add(first, last):
        spark.range(first, last).select("id", F.lit("x").alias("v")).coalesce(1).write.mode("append").parquet(source)

    def load(**more):
        return sorted(r.id for r in load_files_once(spark, source, schema, out, state, **more).collect())

    add(0, 10)
    assert load() == list(range(10))
    for first in (10, 20, 30):
        add(first, first + 10)
    assert load(per_batch=2) == list(range(40))
    # The data of the last batch is there, its mark is not.
    commits = Path(state.removeprefix("file:")) / "commits"
    newest = max(int(c.name) for c in commits.iterdir() if c.name.isdigit())
    for mark in (commits / str(newest), commits / f".{newest}.crc"):
        mark.unlink(missing_ok=True)
    add(40, 50)
    assert load() == list(range(50))
    assert load() == list(range(50))


def test_a_failed_load_of_files_takes_them_again(spark, folder):
    source, out, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    spark.range(7).write.parquet(source)

    def broken(rows):
        return rows.select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))

    with pytest.raises(Exception, match="no"):
        load_files_once(spark, source, "id bigint", out, state, change=broken)
    doubled = load_files_once(spark, source, "id bigint", out, state, change=lambda r: r.select((r.id * 2).alias("id")))
    assert rows(doubled, "id") == [(2 * i,) for i in range(7)]
    (Path(folder.removeprefix("file:")) / "none").mkdir(parents=True)
    assert load_files_once(spark, f"{folder}/none", "id bigint", f"{out}2", f"{state}2").count() == 0


def test_backfill_is_idempotent_and_passes_empty_days(spark, folder):
    data = table(spark, (1, ts("2024-01-01T05:00:00"), "a"), (2, ts("2024-01-03T23:59:59.999999"), "b"), (3, ts("2024-01-04"), "c"))
    for _ in range(2):
        backfill(data, folder, "ts", "2024-01-01", "2024-01-03")
    assert [r.id for r in spark.read.parquet(folder).orderBy("id").collect()] == [1, 2]


def test_daily_files_replace_only_their_days(spark, folder):
    write_daily(table(spark, (1, ts("2024-01-01"), "a"), (2, ts("2024-01-02"), "b")), folder, "ts")
    write_daily(table(spark, (3, ts("2024-01-02"), "c")), folder, "ts")
    assert [r.id for r in spark.read.parquet(folder).orderBy("id").collect()] == [1, 3]
    replace_partitions(table(spark, (4, ts("2024-01-01"), "d")).withColumn("day", F.to_date("ts")), folder, "day")
    assert [r.id for r in spark.read.parquet(folder).orderBy("id").collect()] == [3, 4]


def test_versions(spark, folder):
    full_refresh(table(spark, (1, ts("2024-01-01"), "a"), (2, ts("2024-01-02"), "b")), folder)
    stage = table(spark, (2, ts("2024-01-05"), "x"), (3, ts("2024-01-05"), "y"))
    for _ in range(2):
        delete_insert_by_key(stage, folder, ["id"])
    assert [r.v for r in read_version(spark, folder).orderBy("id").collect()] == ["a", "x", "y"]
    spark.range(1).write.parquet(f"{folder}/v=000004/_temporary/part")  # a run that did not finish
    upsert_by_key(table(spark, (3, ts("2024-01-06"), "z"), (3, ts("2024-01-07"), "w")), folder, ["id"], seq="ts")
    assert [r.v for r in read_version(spark, folder).orderBy("id").collect()] == ["a", "x", "w"]
    assert len(list_versions(spark, folder)) == 4


def test_parts_keep_the_first(spark, folder):
    for part, rows_ in (("a", [("1", "x"), ("2", "y")]), ("b", [("2", "z"), ("3", "w")])):
        spark.createDataFrame(rows_, "id string, v string").write.option("sep", "\t").option("header", True).csv(f"{folder}/{part}")
    assert rows(read_parts(spark, f"{folder}/a", f"{folder}/b", key=["id"])) == [("1", "x"), ("2", "y"), ("3", "w")]


def test_manifest_and_file_lists(spark, folder):
    spark.range(4).repartition(2).write.parquet(f"{folder}/data/2024-01-01")
    spark.range(4, 6).coalesce(1).write.parquet(f"{folder}/data/2024-01-02")
    files = list_files(spark, f"{folder}/data", ext=".parquet")
    files.select(F.concat(F.lit(" "), "path")).unionAll(spark.range(1).select(F.lit(""))).write.text(f"{folder}/manifest")
    assert sorted(r.id for r in read_manifest(spark, f"{folder}/manifest", f"{folder}/data").collect()) == list(range(6))
    groups = []
    assert load_manifest(spark, f"{folder}/manifest", lambda part: groups.append(part.count()), group=2) == 3
    assert sum(groups) == 6 and len(groups) == 2
    dated = files_by_date(files.withColumn("name", F.col("path")), r"(\d{4}-\d{2}-\d{2})/", "2024-01-01")
    assert [str(r.business_date) for r in dated.collect()] == ["2024-01-02"]
    assert list_files(spark, f"{folder}/data", since="2100-01-01").count() == 0
    assert list_files(spark, f"{folder}/data", ext=".parquet", skip="2024-01-02").count() == 2


def test_manifest_of_many_lines(spark, folder):
    """50,000 lines: files, each listed often and in several spellings; a line without a file is an error."""
    spark.range(0, 40, 1, 20).write.parquet(f"{folder}/data/a b")
    spark.range(40, 50).coalesce(1).write.parquet(f"{folder}/data/other")
    files = list_files(spark, f"{folder}/data/a b", ext=".parquet").select("path")
    bare = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    many = files.unionAll(bare).crossJoin(spark.range(1250)).select("path")
    assert many.count() == 50_000
    many.write.text(f"{folder}/list")
    read = read_manifest(spark, f"{folder}/list", f"{folder}/data")
    assert sorted(r.id for r in read.collect()) == list(range(40)) and read.columns == ["id"]
    many.unionAll(spark.createDataFrame([(f"{folder}/data/none.parquet",)], "path string")).write.text(f"{folder}/bad")
    with pytest.raises(FileNotFoundError, match="1 listed"):
        read_manifest(spark, f"{folder}/bad", f"{folder}/data")


def test_files_are_chosen_before_they_are_opened(spark, folder):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "none"):
        spark.range(2).withColumn("d", F.lit(day)).coalesce(1).write.parquet(f"{folder}/data/day={day}")
    schema = spark.read.parquet(f"{folder}/data/day=none").schema

    def chosen(**conditions):
        frame = read_chosen(spark, f"{folder}/data", schema, **conditions)
        return sorted({r.d for r in frame.collect()}), frame.rdd.getNumPartitions()

    pattern = r"day=(\d{4}-\d{2}-\d{2})/"
    assert chosen(date_pattern=pattern)[0] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert chosen(date_pattern=pattern, loaded_until="2024-01-02") == (["2024-01-03"], 1)
    assert chosen(contains="-01-0", skip="-02")[0] == ["2024-01-01", "2024-01-03"]
    assert chosen(since="2100-01-01 00:00:00") == ([], 0)
    assert len(chosen(since="2000-01-01 00:00:00")[0]) == 4
    # A file that no condition chooses may be broken.
    with open(f"{folder.removeprefix('file:')}/data/day=none/broken.parquet", "w") as broken:
        broken.write("x")
    assert chosen(date_pattern=pattern, loaded_until="2024-01-01")[0] == ["2024-01-02", "2024-01-03"]


def test_formats(spark, folder):
    data = table(spark, (1, ts("2024-01-01T00:00:00.123456"), "a"))
    for kind in ("parquet", "csv", "json"):
        write_format(data, f"{folder}/{kind}", kind)
        back = spark.read.schema(data.schema).option("header", True).format(kind).load(f"{folder}/{kind}")
        assert rows(back) == rows(data)
    with pytest.raises(ValueError):
        write_format(data, folder, "avro")
    assert read_csv(spark, f"{folder}/csv").schema["id"].dataType.simpleString() == "string"


def test_file_count(spark, folder):
    assert write_files(spark.range(1000), f"{folder}/six", 6).count() == 6
    assert write_files(spark.range(0, 1000, 1, 8), f"{folder}/two", 2, merge_only=True).count() == 2


def test_files_are_merged_from_parts_written_aside(spark, folder, monkeypatch):
    data = spark.range(9000).withColumn("v", F.concat(F.lit("v"), "id"))
    asked = []
    kept = writers.materialise
    monkeypatch.setattr(writers, "materialise", lambda df, label: asked.append(label) or kept(df, label))
    assert write_files(data, f"{folder}/small", 3).count() == 3 and not asked
    monkeypatch.setattr(writers, "SHARE", 10_000)
    assert write_files(data, f"{folder}/three", 3).count() == 3 and asked == ["parts"]
    back = spark.read.parquet(f"{folder}/three")
    assert rows(back) == rows(data)
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 3 and max(per_file) <= 1.2 * min(per_file)
    assert write_files(data.where("id < 0"), f"{folder}/none", 3).count() <= 3
    assert spark.read.parquet(f"{folder}/none").count() == 0


def test_next_version_of_an_empty_target(spark):
    empty = spark.createDataFrame([], "version bigint")
    assert next_version(spark.range(1), empty).first().version == 1


def test_reconcile(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "d string")
    b = spark.createDataFrame([("x",), ("z",)], "d string")
    assert rows(reconcile(a, b, "d")) == [("x", 2, 1, False), ("y", 1, 0, False), ("z", 0, 1, False)]


def test_load_log(spark, folder):
    for _ in range(2):
        write_logged(spark.range(7), "m", "2024-01-01", "2024-01-02", f"{folder}/m", f"{folder}/log")
    assert rows(spark.read.parquet(f"{folder}/log")) == [("m", "2024-01-01", 7, "2024-01-02")] * 2


def test_jdbc_options():
    got = jdbc_options("jdbc:x", table="a.b", fetch=10, user="u")
    assert got == {"url": "jdbc:x", "fetchsize": "10", "dbtable": "a.b", "user": "u"}
    assert jdbc_options("jdbc:x", query="SELECT 1")["query"] == "SELECT 1"
    for bad in ({}, {"table": "a", "query": "b"}, {"table": "a; drop"}):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", **bad)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
