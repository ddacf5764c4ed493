"""Cases that the supplied tables do not hold: NULL keys and times, empty loads, equal file times, large numbers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace.functions import casts
from millrace.operators.aggregates import collect_if
from millrace.operators.intervals import interval_join
from millrace.operators.ordering import exact_quantiles, page, pick_one
from millrace.operators.sets import delete_insert
from millrace.session import materialise, remove_scratch, scratch_path
from millrace.sources.incremental import load_new_files, load_past_mark
from millrace.sources.readers import table_exists
from millrace.sources.writers import bucket_count, full_refresh, keep_versions, list_versions, read_version, upsert_buckets
from millrace.streaming.streams import route_images, unreadable

from .conftest import rows


def test_pages_are_ordered_at_any_depth(spark):
    df = spark.range(5000).repartition(7).select("id", F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("pad"))
    for offset in (0, 10, 4321):
        assert [r.id for r in page(df, ["id"], 50, offset).collect()] == list(range(offset, offset + 50))


def test_versions_are_ordered_by_number(spark, folder):
    for v in ("999999", "1000000"):
        spark.range(int(v) - 999_998).write.parquet(f"{folder}/v={v}")
    assert read_version(spark, folder).count() == 2
    assert full_refresh(spark.range(7), folder).endswith("v=1000001")
    assert read_version(spark, folder).count() == 7
    assert len(keep_versions(spark, folder, last=2)) == 1 and len(list_versions(spark, folder)) == 2


def test_upsert_rewrites_touched_buckets_only(spark, folder):
    old = spark.range(200).select("id", F.lit("a").alias("v"), F.lit(1).alias("seq"))
    upsert_buckets(old, folder, ["id"], buckets=8, seq="seq")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.endswith(".parquet")}

    before = files()
    upsert_buckets(spark.createDataFrame([(5, "b", 2), (5, "c", 1)], "id long, v string, seq int"), folder, ["id"], buckets=8, seq="seq")
    assert len({os.path.dirname(f) for f in before - files()}) == 1
    table = spark.read.parquet(folder)
    assert table.count() == 200 and rows(table.where("v <> 'a'").select("id", "v")) == [(5, "b")]


def test_loads_start_empty_and_keep_undated_rows(spark, folder):
    kind = "id long, ts timestamp_ntz"
    at = dt.datetime(2024, 1, 1, 12)
    first = spark.createDataFrame([(1, at), (2, None)], kind)
    assert load_past_mark(first.where("false"), folder, "ts", ["id"]).count() == 0
    assert load_past_mark(first, folder, "ts", ["id"]).count() == 2
    later = first.unionByName(spark.createDataFrame([(3, at), (4, None), (5, at + dt.timedelta(days=1))], kind))
    for _ in range(2):
        assert rows(load_past_mark(later, folder, "ts", ["id"]).select("id")) == [(1,), (2,), (3,), (4,), (5,)]


def test_files_of_one_millisecond(spark, folder):
    seen = []
    source, state = f"{folder}/in", f"{folder}/state"
    local = source.removeprefix("file:")

    def load():
        return load_new_files(spark, source, state, "s", lambda paths: seen.extend(os.path.basename(p) for p in paths), group=1)

    def put(name, when):
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/{name}.parquet", "w") as f:
            f.write("x")
        os.utime(f"{local}/{name}.parquet", (when, when))

    put("a", 1_700_000_000)
    assert load() == 1
    put("b", 1_700_000_000)
    put("c", 1_700_000_001)
    assert load() == 2 and load() == 0
    assert seen == ["a.parquet", "b.parquet", "c.parquet"]


def test_picks_prefer_values(spark):
    df = spark.createDataFrame([(1, None, "bad"), (1, 1, "good"), (2, None, "only")], "k int, t int, v string")
    assert rows(pick_one(df, ["k"], ["t"]).select("k", "v")) == [(1, "good"), (2, "only")]
    assert rows(pick_one(df, ["k"], ["t"], last=True).select("k", "v")) == [(1, "good"), (2, "only")]


def test_null_is_a_key(spark):
    target = spark.createDataFrame([(None, "old"), (1, "old")], "k int, v string")
    stage = spark.createDataFrame([(None, "new")], "k int, v string")
    once = delete_insert(target, stage, ["k"])
    assert rows(delete_insert(once, stage, ["k"])) == rows(once) == [(1, "old"), (None, "new")]


def test_groups_without_values_have_null_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert rows(exact_quantiles(df, ["k"], "v", {"m": 0.5})) == [("a", 2.0), ("b", None)]


def test_wide_wrap(spark):
    df = spark.createDataFrame([("9007199254740993",), ("-1",), ("x",), ("18446744073709551616",), ("7.9",)], "v string")
    c = F.col("v")
    got = [tuple(map(int, r)) for r in df.select(casts.cast_unsigned(c, 8), casts.cast_unsigned(c, 64)).collect()]
    assert got == [(1, 9007199254740993), (255, 2**64 - 1), (0, 0), (0, 0), (7, 7)]


@pytest.mark.parametrize(
    ("text", "items"),
    [("['a,b','c']", ["a,b", "c"]), ('["O\'Brien"]', ["O'Brien"]), ("[1, 2,,3]", ["1", "2", "3"]), ("[]", []), ("[2024-01-02]", ["2024-01-02"]), (None, None)],
)
def test_lists_as_text(spark, text, items):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(casts.parse_list_text(F.col("v"), "string")).first()[0] == items


def test_conditional_lists_keep_all_keys(spark):
    df = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "c", False)], "k int, v string, ok boolean")
    assert rows(collect_if(df, ["k"], "v", F.col("ok"), ["v"], 10)) == [(1, 0, ["a"]), (2, 0, [])]


def test_interval_join_with_shared_names(spark):
    points = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5))], "id int, ts timestamp_ntz")
    spans = spark.createDataFrame([(9, dt.datetime(2024, 1, 1, 4), dt.datetime(2024, 1, 1, 6))], "id int, a timestamp_ntz, b timestamp_ntz")
    assert rows(interval_join(points, spans, "ts", "a", "b").select("id", "id_interval")) == [(1, 9)]


def test_unreadable_changes_are_not_published(spark):
    df = spark.createDataFrame([('{"before": {"id": 1}}',), ("{broken",)], "value string")
    assert route_images(df).count() == 1 and unreadable(df).count() == 1


def test_scratch_can_be_freed(spark):
    path = scratch_path(spark, "freed")
    spark.range(3).write.parquet(path)
    assert table_exists(spark, path)
    remove_scratch(spark, path)
    assert not table_exists(spark, path)
    with pytest.raises(ValueError):
        remove_scratch(spark, path)
    assert materialise(spark.range(2), "kept").count() == 2


def test_bucket_count():
    assert bucket_count(0) == 1 and bucket_count(0, least=8) == 8 and bucket_count(9 << 28) == 16
