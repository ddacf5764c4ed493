"""Results when one key holds a large share of the rows, against brute force."""

import bisect
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import collect_groups
from millrace.operators.asof import asof_join
from millrace.operators.intervals import interval_join
from millrace.operators.ordering import (
    PART,
    Key,
    exact_quantiles,
    first_non_null,
    in_even_ranges,
    neighbours,
    number_rows,
    pick_one,
    rank_rows,
    running_sum,
    with_group_values,
)
from millrace.sources.writers import write_colocated

from .conftest import rows


@pytest.fixture(scope="module")
def data():
    """id, key, time, value; key 0 holds a third of the rows and NULL is a key as well."""
    rnd = random.Random(5)
    out = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.choice([None, *range(1, 40)])
        out.append((i, key, rnd.randrange(2000), rnd.randrange(50) if rnd.random() < 0.9 else None))
    return out


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, "id int, k int, t int, v int").repartition(8, "id").cache()


def nulls_last(x):
    return (x is None, 0 if x is None else x)


def test_numbering_by_key_on_both_ways(table, data):
    expected = {}
    groups = defaultdict(list)
    for i, k, t, _ in data:
        groups[k].append((t, i))
    for members in groups.values():
        for n, (_, i) in enumerate(sorted(members), start=1):
            expected[i] = n
    for small in (False, True):
        got = number_rows(table, ["t", "id"], ["k"], "n", small_keys=small)
        assert {r.id: r.n for r in got.collect()} == expected


def test_numbering_all_rows(table, data):
    order = sorted(data, key=lambda r: (nulls_last(r[3]), r[0]))
    got = number_rows(table, [Key("v"), "id"], name="n")
    assert [r.id for r in got.orderBy("n").collect()] == [r[0] for r in order]
    assert [r.n for r in got.orderBy("n").collect()] == list(range(1, len(data) + 1))


def test_neighbours_cross_ranges(table, data):
    order = [r[0] for r in sorted(data, key=lambda r: (r[2], r[0]))]
    got = {r.id: (r.p, r.n) for r in neighbours(table, ["t", "id"], "id", "p", "n").collect()}
    for place, i in enumerate(order):
        assert got[i] == (order[place - 1] if place else None, order[place + 1] if place + 1 < len(order) else None)


def test_rank_and_running_sum(table, data):
    values = sorted((r[1] for r in data), key=nulls_last)
    distinct = sorted(set(values), key=nulls_last)
    first = {v: values.index(v) + 1 for v in distinct}
    for r in rank_rows(table, [Key("k")]).collect():
        assert (r["rank"], r.dense_rank) == (first[r.k], distinct.index(r.k) + 1)
    upto, total = {}, None
    for k in distinct:
        for v in (r[3] for r in data if r[1] == k):
            if v is not None:
                total = (total or 0) + v
        upto[k] = total
    for r in running_sum(table, [Key("k")], F.col("v"), "s").collect():
        assert r.s == upto[r.k]


def test_quantiles(table, data):
    groups = defaultdict(list)
    for _, k, _, v in data:
        if v is not None:
            groups[k].append(v)
    got = {r.k: (r.a, r.b) for r in exact_quantiles(table, ["k"], "v", {"a": 0.25, "b": 0.9}).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        values.sort()
        for p, seen in zip((0.25, 0.9), got[k]):
            place = (len(values) - 1) * p
            lo = values[int(place)]
            hi = values[min(int(place) + 1, len(values) - 1)]
            assert seen == pytest.approx(lo + (hi - lo) * (place - int(place)))


def test_collecting_splits_large_groups(table, data):
    groups = defaultdict(list)
    for i, k, t, _ in data:
        groups[k].append((t, i))
    lists = collect_groups(table, ["k"], "id", ["t", "id"], chunk_rows=100)
    got = defaultdict(dict)
    for r in lists.collect():
        assert len(r["items"]) <= 100
        got[r.k][r.chunk] = r["items"]
    assert len(got[0]) == 10
    for k, members in groups.items():
        assert [i for c in sorted(got[k]) for i in got[k][c]] == [i for _, i in sorted(members)]


def test_group_picks(table, data):
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r)
    low = {r.k: r.id for r in pick_one(table, ["k"], ["t", "id"]).collect()}
    high = {r.k: r.id for r in pick_one(table, ["k"], ["t", "id"], last=True).collect()}
    filled = {r.id: r.f for r in first_non_null(table, ["k"], "v", ["t", "id"], "f").collect()}
    sizes = {r.id: r.n for r in with_group_values(table, ["k"], F.count("*").alias("n")).collect()}
    for k, members in groups.items():
        members.sort(key=lambda r: (r[2], r[0]))
        assert (low[k], high[k]) == (members[0][0], members[-1][0])
        first = next((r[3] for r in members if r[3] is not None), None)
        for r in members:
            assert (filled[r[0]], sizes[r[0]]) == (first, len(members))


@pytest.mark.parametrize("op", ["<", "<=", ">", ">="])
@pytest.mark.parametrize("slot", [None, 50, 100_000])
def test_asof(spark, table, data, op, slot):
    left, right = table.where("id % 2 = 0"), table.where("id % 2 = 1").select("k", "t", F.col("id").alias("rid"))
    by_key = defaultdict(list)
    for i, k, t, _ in data:
        if i % 2 and k is not None:
            by_key[k].append((t, i))
    for members in by_key.values():
        members.sort()
    expected = {}
    for i, k, t, _ in data:
        if i % 2 == 0 and k is not None:
            members = by_key[k]
            match op:
                case "<":
                    at = bisect.bisect_left(members, (t + 1,))
                case "<=":
                    at = bisect.bisect_left(members, (t,))
                case ">":
                    at = bisect.bisect_left(members, (t,)) - 1
                case ">=":
                    at = bisect.bisect_left(members, (t + 1,)) - 1
            if 0 <= at < len(members):
                expected[i] = members[at][1]
    got = asof_join(left, right, ["k"], "t", "t", op, tie="rid", slot=slot)
    assert {r.id: r.rid for r in got.collect()} == expected
    outer = asof_join(left, right, ["k"], "t", "t", op, tie="rid", slot=slot, how="left")
    assert {r.id: r.rid for r in outer.collect()} == {r[0]: expected.get(r[0]) for r in data if r[0] % 2 == 0}


def test_asof_ranges_stay_even_for_one_key_at_one_time(spark):
    """A third of the rows share key and time; the ranges of the join hold about the same number of rows."""
    rows_ = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), F.lit(5).alias("t"))
    parts = in_even_ranges(rows_, ["k", "t"]).groupBy(PART).count().collect()
    assert len(parts) == 4 and max(p["count"] for p in parts) < 2 * min(p["count"] for p in parts)
    right = spark.createDataFrame([(0, 6, "x"), (0, 6, "a"), (0, 4, "y"), (1, 9, "z")], "k bigint, t int, v string")
    found = asof_join(rows_, right, ["k"], "t", "t", "<", tie="v").groupBy("k", "v").count()
    assert sorted(tuple(r) for r in found.collect()) == [
        (0, "a", 20_000 + sum(i % 3 != 0 and i % 7 == 0 for i in range(60_000))),
        (1, "z", sum(i % 3 != 0 and i % 7 == 1 for i in range(60_000))),
    ]


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_intervals(spark, table, data, limit):
    rnd = random.Random(9)
    spans = [(n, rnd.choice([0, 0, 3, 4]), a, a + rnd.randrange(-5, 300)) for n, a in ((n, rnd.randrange(2000)) for n in range(60))]
    intervals = spark.createDataFrame(spans, "n int, k int, a int, b int")
    expected = sorted((i, n) for i, k, t, _ in data for n, q, a, b in spans if k == q and a <= t <= b)
    got = interval_join(table, intervals, "t", "a", "b", on=["k"], slot=64, broadcast_bytes=limit)
    assert sorted((r.id, r.n) for r in got.collect()) == expected
    expected = sorted((i, n) for i, k, t, _ in data for n, _, a, b in spans if a <= t <= b)
    got = interval_join(table.drop("k"), intervals, "t", "a", "b", slot=64, broadcast_bytes=limit)
    assert sorted((r.id, r.n) for r in got.collect()) == expected


def test_peers_over_many_ranges(spark):
    """One value holds most of the rows, so that it fills several ranges and begins and ends inside others."""
    rnd = random.Random(9)
    data = [(i, 5 if rnd.random() < 0.7 else rnd.choice([None, 1, 2, 5, 7, 9]), rnd.choice([None, 1, 2])) for i in range(2000)]
    ordered = sorted(data, key=lambda r: nulls_last(r[1]))
    values = [r[1] for r in ordered]
    distinct = sorted(set(values), key=nulls_last)
    df = spark.createDataFrame(data, "id int, k int, v int").repartition(8, "id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        ranked = rank_rows(df, [Key("k")])
        assert rows(ranked.select("id", "rank", "dense_rank")) == sorted(
            ((i, values.index(k) + 1, distinct.index(k) + 1) for i, k, _ in data), key=lambda t: tuple((False, str(v)) for v in t)
        )
        summed = {r.id: r.s for r in running_sum(df, [Key("k")], F.col("v"), "s").collect()}
        for i, k, _ in data:
            upto = [v for _, other, v in ordered if nulls_last(other) <= nulls_last(k) and v is not None]
            assert summed[i] == (sum(upto) if upto else None)
        nothing = running_sum(df, [Key("k")], F.when(F.col("k") > 5, F.col("v")), "s").where("k <= 5")
        assert nothing.where("s IS NOT NULL").count() == 0
        assert rank_rows(df.limit(0), [Key("k")]).count() == 0
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_colocated_join_splits_a_heavy_key(spark, folder):
    """A third of the rows on one key and some on NULL: no shuffle, even buckets, every pair once."""
    rnd = random.Random(3)
    lines = [(i, 7 if i % 3 == 0 else None if i % 10 == 1 else rnd.randrange(1000)) for i in range(6000)]
    names = [(k, f"n{k}") for k in range(900)] + [(7, "again"), (None, "none")]
    many = spark.createDataFrame(lines, "id int, k int")
    one = spark.createDataFrame(names, "key int, name string")
    tables = tuple(f"{t}_{folder[-32:]}" for t in ("many", "one"))
    left, right = write_colocated(many, one, tables, (f"{folder}/many", f"{folder}/one"), ("k", "key"), 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.join(right, (left["k"] == right["key"]) & (left["part"] == right["part"])).select("id", "name")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        by_key = defaultdict(list)
        for k, name in names:
            by_key[k].append(name)
        assert rows(joined) == sorted(((i, n) for i, k in lines if k is not None for n in by_key[k]), key=lambda t: tuple((False, str(v)) for v in t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    sizes = sorted(r["count"] for r in left.groupBy(F.col("_metadata.file_path")).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    assert left.where("k = 7").select("part").distinct().count() >= 4
    assert right.where("part = 0").count() == len(names)
    spark.sql(f"DROP TABLE {tables[0]}")
    spark.sql(f"DROP TABLE {tables[1]}")
