"""Small cases with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import casts, nested, texts, times
from millrace.operators.aggregates import collect_groups, count_distinct_if, sum_if
from millrace.operators.asof import asof_join
from millrace.operators.ordering import Key, exact_quantiles, neighbours, number_rows, page, rank_rows, running_sum
from millrace.operators.sets import union_coerced, upsert
from millrace.session import materialise
from millrace.operators.states import State, finalize, merge_states, read_aggregating, to_state
from millrace.operators.tables import (
    ColumnRule,
    RuleError,
    TargetField,
    conform,
    read_collapsing,
    read_replacing,
    read_rules,
    read_summing,
    ttl_column,
    ttl_rows,
    visible,
    write_rules,
)
from millrace.plans.bars import ohlcv, rebuild_tail
from millrace.plans.cards import ISSUED, first_transaction
from millrace.plans.feeds import page_view_answers, users_per_device
from millrace.plans.shops import shop_timezone
from millrace.plans.users import survey_users
from millrace.plans.web import join_hits, web_depth
from millrace.plans.weather import weather_hourly

from .conftest import rows


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_shop_timezone(spark):
    shops = spark.createDataFrame(
        [(842, "Lenta"), (843, "Magnit"), (844, "Spar"), (845, "Pyaterochka"), (847, "Diksi"), (848, "Lenta"), (850, "New")],
        "st_id int, shop_name string",
    )
    zones = spark.createDataFrame(
        [("842", "RUS07"), ("843", "RUS04"), ("843", ""), ("844", " "), ("845", "RUS05"), ("847", None), ("848", "RUS08"), ("V001", "RUS02")],
        "plant string, time_zone string",
    )
    expected = [(842, "Lenta", 7), (843, "Magnit", 4), (844, "Spar", 3), (845, "Pyaterochka", 5), (847, "Diksi", 3), (848, "Lenta", 8)]
    assert rows(shop_timezone(shops, zones), "st_id") == expected
    assert rows(shop_timezone(shops, zones, keep_unmatched=True), "st_id") == [*expected, (850, "New", 3)]
    ten = spark.createDataFrame([("842", "RUS10")], "plant string, time_zone string")
    assert rows(shop_timezone(shops, ten)) == [(842, "Lenta", 10)]


def test_survey_users(spark):
    a = spark.createDataFrame([("@64", "@ann", "1", "2025-09-11T00:00:00.000Z"), ("7@@", "bob", "2", "2025-09-12T00:00:00.000Z")], "tg_id string, tg_nickname string, pk_id string, update_at string")
    b = spark.createDataFrame([("@@@64", "anna", "9", "2025-09-10T00:00:00.000Z"), ("none", "x", "3", "2025-09-12T00:00:00.000Z")], a.schema)
    assert rows(survey_users(a, b), "telegram_id") == [(7, "bob", dt.date(2025, 9, 12)), (64, "anna", dt.date(2025, 9, 10))]


def test_weather_pads_short_arrays_and_skips_null(spark):
    raw = spark.createDataFrame(
        [(["2024-01-01T00:00", "2024-01-01T01:00"], [1.5, 2.5], [0.5]), (None, [1.0], [2.0])],
        "`hourly.time` array<string>, `hourly.temperature_2m` array<double>, `hourly.rain` array<double>",
    )
    got = rows(weather_hourly(raw, F.lit("2024-02-01").cast("timestamp_ntz")).drop("updated_at"), "time")
    assert got == [("2024-01-01T00:00", 1.5, 0.5, dt.date(2024, 1, 1)), ("2024-01-01T01:00", 2.5, None, dt.date(2024, 1, 1))]


def employees(spark):
    data = [(1, "HR", 50000), (2, "IT", None), (3, "Finance", 60000), (4, "IT", 80000), (5, "HR", 52000)]
    return spark.createDataFrame(data, "id int, department string, salary int")


def test_order_with_nulls(spark):
    e = employees(spark)
    assert [int(r.salary) for r in page(e, ["salary", "id"], 2, 2).collect()] == [60000, 80000]
    down = [Key("salary", desc=True, nulls_first=True), Key("id")]
    assert [r.id for r in number_rows(e, down).orderBy("row_num").collect()] == [2, 4, 3, 5, 1]
    seen = neighbours(e, down, "id", "prev", "next").orderBy("id").collect()
    assert [(r.prev, r.next) for r in seen] == [(5, None), (None, 4), (4, 5), (2, 3), (3, 1)]


def test_rank_and_running_sum_include_peers(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None), (5, 20)], "id int, v int")
    ranks = rank_rows(df, [Key("v", nulls_first=True)])
    assert [(r.id, r["rank"], r.dense_rank) for r in ranks.orderBy("id").collect()] == [(1, 2, 2), (2, 2, 2), (3, 4, 3), (4, 1, 1), (5, 4, 3)]
    total = running_sum(df, [Key("v", nulls_first=True)], F.col("v"), "s")
    assert [(r.id, r.s) for r in total.orderBy("id").collect()] == [(1, 20), (2, 20), (3, 60), (4, None), (5, 60)]


def test_page_views(spark):
    views = spark.createDataFrame(
        [(1, "home", "mobile", 10), (1, "catalog", "mobile", 15), (2, "home", "web", 8), (2, "checkout", "web", 20), (2, "home", "mobile", 5),
         (4, "catalog", "web", 12), (5, "checkout", "mobile", 7), (6, "home", "web", 9), (7, "home", "mobile", 11), (8, "catalog", "web", 13)],
        "user_id int, page string, device string, view_time int",
    )
    assert rows(page_view_answers(views)) == [(4, 8.6)]
    assert rows(users_per_device(views)) == [("mobile", 4), ("web", 4)]
    pages = collect_groups(views.where("user_id = 2 AND device = 'web'").withColumn("n", F.col("view_time")), ["user_id"], "page", ["n"], chunk_rows=100)
    assert rows(pages) == [(2, 0, ["home", "checkout"])]


def test_conditional_aggregates(spark):
    t = spark.range(10).select("id", (F.col("id") * 10).alias("s"), (F.col("id") % 3).alias("d"))
    got = t.agg(sum_if(F.col("s"), F.col("id") % 2 == 0), F.countDistinct("d"), count_distinct_if(F.col("d"), F.col("d") % 2 == 0))
    assert rows(got) == [(200, 3, 2)]


def test_list_text_is_the_same_cut_or_read(spark):
    """Lists that are only cut and lists that are read as JSON, with the items either way gives."""
    cases = {
        "[1, 2,3]": [1, 2, 3],
        "['1','2']": [1, 2],
        "[\"1\", ' 2 ']": [1, 2],
        "['1,2', 3]": [None, 3],
        "['','-4',,]": [-4],
        "[null, 5]": [5],
        "'7','8": [7, 8],
        "[]": [],
        "[ ]": [],
        "x": [None],
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string").select("t", casts.parse_list_text(F.col("t"), "int64").alias("v"))
    assert {r.t: r.v for r in df.collect() if r.t is not None} == cases
    assert df.where("t IS NULL").first().v is None
    long = spark.range(1).select(casts.parse_list_text(F.concat(F.lit("["), F.repeat(F.lit("'12', "), 200_000), F.lit("3]")), "int64").alias("v"))
    assert long.select(F.size("v")).first()[0] == 200_001


def test_simple_states(spark):
    spec = {"val_sum": State("sum", "v"), "val_max": State("max", "v")}
    one, two = (spark.range(n).select(F.lit(1).alias("id"), F.col("id").alias("v")) for n in (10, 8))
    other = spark.range(5).select(F.lit(2).alias("id"), F.col("id").alias("v"))
    stored = to_state(one, ["id"], spec).unionByName(to_state(other, ["id"], spec)).unionByName(to_state(two, ["id"], spec))
    assert stored.count() == 3
    assert rows(read_aggregating(stored, ["id"], spec)) == [(1, 73, 9), (2, 10, 4)]


def test_state_merge_law(spark):
    data = spark.range(1, 11).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    spec = {"n": State("count", "v"), "mean": State("avg", "v"), "u": State("uniq", "v"), "even": State("any_if", "v", cond="v % 2 = 0")}
    halves = [to_state(data.where(c), ["k"], spec) for c in ("v <= 4", "v > 4")]
    merged = finalize(merge_states(halves[0].unionByName(halves[1]), ["k"], spec), ["k"], spec)
    direct = finalize(to_state(data, ["k"], spec), ["k"], spec)
    assert rows(merged) == rows(direct)
    assert [(r.k, r.n, r["mean"]) for r in merged.orderBy("k").collect()] == [(0, 2, 6.0), (1, 3, 5.0), (2, 3, 6.0), (3, 2, 5.0)]


def test_list_states_follow_the_merge_law(spark):
    """Lists longer than a chunk, of uneven loads, with equal and missing values, beside other states."""
    data = spark.range(60).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("int")).otherwise(F.col("id").cast("int") % 3).alias("k"),
        (F.col("id") * 7 % 30).alias("t"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 4).alias("v"),
    )
    data = data.unionByName(spark.createDataFrame([(9, 1, None)], data.schema))
    spec = {
        "n": State("count", "v"),
        "u": State("uniq", "v"),
        "q": State("quantiles", "v", probs=(0.5,)),
        "late": State("list", "v", order=("t",), chunk_rows=4),
        "sorted": State("list", "v", chunk_rows=7),
    }
    loads = [to_state(data.where(c), ["k"], spec) for c in ("t < 3", "t >= 3 AND t % 2 = 0", "t >= 3 AND t % 2 = 1")]
    stored = materialise(loads[0].unionByName(loads[1]).unionByName(loads[2]), "states")
    merged = read_aggregating(stored, ["k"], spec)
    merged = materialise(merged, "merged")
    got = sorted(merged.collect(), key=lambda r: r.chunk)
    expected = rows(merged)
    assert expected == rows(finalize(to_state(data, ["k"], spec), ["k"], spec))
    twice = merge_states(merge_states(loads[0].unionByName(loads[1]), ["k"], spec).unionByName(loads[2]), ["k"], spec)
    assert rows(finalize(twice, ["k"], spec)) == expected
    plain = data.collect()
    for k in (None, 1, 2, 9):
        mine = [r for r in got if r.k == k]
        assert [r.chunk for r in mine] == list(range(len(mine))) and all(r.n is None for r in mine[1:])
        values = [r for r in plain if r.k == k and r.v is not None]
        late = [r.late for r in mine if r.late is not None]
        assert [v for part in late for v in part] == [r.v for r in sorted(values, key=lambda r: (r.t, r.v))]
        assert all(len(part) == 4 for part in late[:-1])
        assert [v for r in mine for v in r.sorted or []] == sorted(r.v for r in values)
    assert [(r.chunk, r.n, r.late, r.sorted) for r in got if r.k == 9] == [(0, 0, [], [])]
    assert read_aggregating(stored.limit(0), ["k"], spec).count() == 0


def test_quantiles(spark):
    t = spark.range(10).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("v"))
    assert rows(exact_quantiles(t, ["k"], "v", {"a": 0.5, "b": 0.9})) == [(1, 45.0, 81.0)]
    q = State("quantiles", "v", probs=(0.5, 0.9))
    est = read_aggregating(to_state(t, ["k"], {"q": q}), ["k"], {"q": q}).first().q
    assert est[0] in (40.0, 50.0) and est[1] in (80.0, 90.0)


def test_replacing(spark):
    rows_ = [(1, dt.date(2024, 1, 17) + dt.timedelta(days=i), (i + 1) * 1000, i) for i in range(10)] + [(1, dt.date(2024, 1, 26), 5, 99)]
    t = spark.createDataFrame(rows_, "id int, dt date, val int, seq int")
    assert rows(read_replacing(t.where("seq < 99"), ["id"], "seq", "dt").select("val")) == [(10000,)]
    assert rows(read_replacing(t, ["id"], "seq", "dt").select("val")) == [(5,)]  # tie on version: last inserted
    months = t.withColumn("m", F.month("dt") + F.col("seq") % 2)
    assert read_replacing(months, ["id"], "seq", "dt", partition=["m"]).count() == 2


def test_summing(spark):
    t = spark.range(30).select(
        (F.col("id") % 2).alias("id"), ((F.col("id") + 1) * 10).alias("val"), F.date_add(F.lit("2024-01-10").cast("date"), F.col("id").cast("int")).alias("dt"),
        ((F.col("id") + 1) * 100).alias("example"), F.col("id").alias("seq"),
    ).withColumn("month", F.month("dt"))
    twice = t.unionByName(t.withColumn("seq", F.col("seq") + 30))
    final = read_summing(twice.drop("month"), ["id"], ["val"], "seq")
    assert [(r.id, r.val, r.example) for r in final.orderBy("id").collect()] == [(0, 4500, 100), (1, 4800, 200)]
    parts = read_summing(twice, ["id"], ["val"], "seq", partition=["month"])
    assert parts.count() == 4
    again = read_summing(parts.drop("month"), ["id"], ["val"], "seq")
    assert rows(again.select("id", "val")) == [(0, 4500), (1, 4800)]


def test_collapsing(spark):
    t = spark.createDataFrame([(1, 1, 1, 0), (1, 1, -1, 1), (1, 2, 1, 2), (2, 5, 1, 3), (2, 5, -1, 4), (3, 1, -1, 5)], "id int, page int, sign int, seq int")
    assert rows(read_collapsing(t, ["id"], "sign", "seq").select("id", "page", "sign")) == [(1, 2, 1)]


def test_ttl(spark):
    as_of = F.lit("2024-01-20").cast("timestamp_ntz")
    t = spark.createDataFrame([(1, ts("2024-01-10"), 5), (2, ts("2024-01-15"), 6), (3, ts("2024-01-15T00:00:01"), 7), (4, None, 8)], "id int, at timestamp_ntz, v int")
    assert [r.id for r in ttl_rows(t, "at", "5 DAYS", as_of).orderBy("id").collect()] == [3, 4]
    assert [r.v for r in ttl_column(t, "v", 10, "at", "5 DAYS", as_of).orderBy("id").collect()] == [10, 10, 7, 8]


def test_computed_columns(spark):
    rules = [ColumnRule("quantity", "default", "1", "int"), ColumnRule("total", "materialized", "price * quantity", "double"), ColumnRule("taxed", "alias", "total * 1.2", "double")]
    given = spark.createDataFrame([(1, 10.5, 2), (2, 5.0, 5)], "id int, price double, quantity int")
    table = read_rules(write_rules(given, rules), rules)
    assert [(r.total, round(r.taxed, 6)) for r in table.orderBy("id").collect()] == [(21.0, 25.2), (25.0, 30.0)]
    assert visible(table, rules).columns == ["id", "price", "quantity"]
    assert write_rules(given.drop("quantity"), rules).first().quantity == 1
    with pytest.raises(RuleError):
        write_rules(given.withColumn("taxed", F.lit(1.0)), rules)


def test_casts(spark):
    t = spark.createDataFrame([("1",), ("2",), ("1a",), ("-1",)], "v string")
    v = F.col("v")
    got = t.select(casts.cast_or_null(v, "int"), casts.cast_or_zero(v, "int"), casts.cast_or_default(v, "int", -100)).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (2, 2, 2), (None, 0, -100), (-1, -1, -1)]
    n = spark.createDataFrame([("-1",), ("-1.1",), ("256",), ("x",)], "v string")
    assert [r[0] for r in n.select(casts.cast_unsigned(F.col("v"), 8)).collect()] == [255, 255, 0, 0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        t.select(casts.cast_strict(v, "int")).collect()
    with pytest.raises(Exception, match="must not be NULL"):
        t.select(casts.cast_strict(F.lit(None).cast("string"), "int")).collect()


def test_times(spark):
    t = spark.createDataFrame([(-1,), (1_704_067_200_123_456_789,)], "n bigint")
    got = [r[0] for r in t.select(times.from_epoch(F.col("n"), "ns")).collect()]
    assert got == [ts("1969-12-31T23:59:59.999999"), ts("2024-01-01T00:00:00.123456")]
    old = spark.createDataFrame([(ts("1969-12-31T23:59:58.999500"),)], "t timestamp_ntz")
    assert old.select(times.truncate_precision(F.col("t"), 3)).first()[0] == ts("1969-12-31T23:59:58.999000")
    sunday = spark.createDataFrame([(ts("2024-01-07"),)], "t timestamp_ntz")
    assert tuple(sunday.select(times.sunday_zero(F.col("t")), times.monday_of(F.col("t"))).first()) == (0, dt.date(2024, 1, 1))


def test_texts(spark):
    t = spark.createDataFrame([("10 km N of A, B",), ("Sea",), (None,)], "p string")
    got = t.select(texts.split_part_trim(F.col("p"), 0), texts.split_part_trim(F.col("p"), 1), texts.split_part_trim(F.col("p"), 1, default="Other")).collect()
    assert [tuple(r) for r in got] == [("10 km N of A", "B", "B"), ("Sea", None, "Other"), (None, None, "Other")]
    codes = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    assert [r[0] for r in codes.select(texts.label_of(F.col("c"), {"1": "desktop"})).collect()] == ["desktop", "9", "unknown"]


def test_list_text(spark):
    t = spark.createDataFrame([("[1, 2,,x]",), ("[]",), (None,)], "v string")
    assert [r[0] for r in t.select(casts.parse_list_text(F.col("v"), "int64")).collect()] == [[1, 2, None], [], None]
    d = spark.createDataFrame([("['2024-01-02T03:04:05.6']",)], "v string")
    assert d.select(casts.parse_list_text(F.col("v"), "datetime64_6")).first()[0] == [ts("2024-01-02T03:04:05.6")]
    ids = nested.explode_id_text(t, "v", "id")
    assert [r.id for r in ids.collect()] == [1, 2, None, None, None]


def test_key_value_lists(spark):
    t = spark.createDataFrame([('[[["nick","a"],["pay","yes"]],[["pay","no"]]]',)], "doc string")
    assert rows(nested.key_value_lists(t, "doc", {"nick": "nickname", "pay": "pay"})) == [("a", "yes"), (None, "no")]


def test_conform(spark):
    t = spark.createDataFrame([("7", None, "[1,2]", ts("2024-01-01T00:00:00.987654"), 1)], "a string, b string, c string, d timestamp_ntz, extra int")
    got = conform(t, [TargetField("d", "datetime64_3"), TargetField("c", "uint8", array=True), TargetField("b", "string"), TargetField("a", "uint32"), TargetField("z", "int8")])
    assert got.columns == ["d", "c", "b", "a"]
    assert tuple(got.first()) == (ts("2024-01-01T00:00:00.987"), [1, 2], "", 7)
    stamps = spark.createDataFrame([("['2024-01-01T00:00:00.9']",)], "s string")
    assert conform(stamps, [TargetField("s", "datetime", array=True)]).first().s == [ts("2024-01-01")]


def test_union_coerced(spark):
    a = spark.createDataFrame([(1, 5)], "id int, n int")
    b = spark.createDataFrame([("2", "x"), ("3", "4")], "id string, n string")
    assert rows(union_coerced({"id": "bigint", "n": "int"}, a, b)) == [(1, 5), (2, None), (3, 4)]
    assert rows(union_coerced({"id": "bigint", "n": "int"}, a, b, defaults={"n": 0})) == [(1, 5), (2, 0), (3, 4)]


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    c = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "id int, v string, seq int")
    assert rows(upsert(t, c, ["id"], "seq")) == [(1, "a"), (2, "d"), (3, "e")]


def test_asof(spark):
    base = spark.range(5).select(F.col("id").alias("k"))

    def at(start, step, name):
        moment = F.timestamp_add("SECOND", F.col("k") * 100 + (3 if name == "b" else 0), F.lit(start).cast("timestamp_ntz"))
        return base.select("k", moment.alias("ts"), (F.col("k") * step).alias(name))

    a = at("2020-10-10 10:30:00", 10, "a")
    b = at("2020-10-10 10:00:00", 100, "b").unionByName(at("2020-10-10 11:00:00", 1000, "b")).unionByName(at("2020-10-10 12:00:00", 10000, "b"))
    got = asof_join(a, b, ["k"], "ts", "ts", "<").orderBy("k").collect()
    assert [(r.k, r.a, r.b) for r in got] == [(k, 10 * k, 1000 * k) for k in range(5)]
    assert got[1].ts_right == ts("2020-10-10T11:01:43")


@pytest.mark.parametrize("op,expected", [("<", 20), ("<=", 11), (">", 5), (">=", 12)])
def test_asof_strictness_and_ties(spark, op, expected):
    left = spark.createDataFrame([(1, 10), (1, None), (2, 10), (None, 10)], "k int, t int")
    right = spark.createDataFrame([(1, 5, 5), (1, 10, 11), (1, 10, 12), (1, 20, 20), (1, None, 0), (None, 10, 1)], "k int, u int, v int")
    for slot in (None, 1, 7, 1000):
        got = asof_join(left, right, ["k"], "t", "u", op, tie="v", slot=slot)
        assert [r.v for r in got.collect()] == [expected]
        outer = asof_join(left, right, ["k"], "t", "u", op, tie="v", how="left", slot=slot)
        assert sorted((r.v is None, r.v or 0) for r in outer.collect()) == [(False, expected), (True, 0), (True, 0), (True, 0)]


def trades(spark, *more):
    data = [(1, "s", 5.0, 1.0, 5.0, ts("2024-01-01T10:00:01")), (2, "s", 7.0, 1.0, 7.0, ts("2024-01-01T10:00:01")), (3, "s", 6.0, 2.0, 12.0, ts("2024-01-01T10:00:59"))]
    return spark.createDataFrame([*data, *more], "trade_id long, symbol string, price double, quantity double, amount_usdt double, ts timestamp_ntz")


def test_bars(spark):
    one = ohlcv(trades(spark)).first()
    assert (one.period_start, one.open_price, one.high_price, one.low_price, one.close_price, one.trades_count) == (ts("2024-01-01T10:00:00"), 5.0, 7.0, 5.0, 6.0, 3)
    late = trades(spark, (4, "s", 9.0, 1.0, 9.0, ts("2024-01-01T10:00:30")), (5, "s", 1.0, 1.0, 1.0, ts("2024-01-01T11:30:00")))
    again = rebuild_tail(ohlcv(trades(spark)), late)
    assert rows(again) == rows(ohlcv(late))
    assert rows(rebuild_tail(again, late)) == rows(again)
    empty = ohlcv(trades(spark).limit(0))
    assert rows(rebuild_tail(empty, late)) == rows(ohlcv(late))


def test_first_transaction(spark):
    day = "2021-05-01"
    cards = spark.createDataFrame([("m1", "d1", "u", "c", day), ("m2", "d2", "u", "c", day)], "card_num_md5 string, card_order_dt string, url string, cookie string, load_date string")
    status = spark.createDataFrame([(ISSUED, "1", "m1", day), ("no", "2", "m2", day)], "status string, card_num string, card_num_md5 string, load_date string")
    spent = spark.createDataFrame(
        [("1", "300", "t2", day), ("1", "99.5", "t1", day), ("1", "300.01", "t1", day), ("2", "300", "t1", day), ("2", "999", "t0", "2021-04-01")],
        "card_num string, amount string, transaction_datetime string, load_date string",
    )
    got = first_transaction(cards, status, spent, day).orderBy("card_num").collect()
    assert [(r.card_num, r.transaction_level, r.status_flag) for r in got] == [("1", True, True), ("2", False, False)]


def test_bounce_by_grain(spark):
    visits = spark.createDataFrame(
        [(ts("2024-01-01"), 1, 1, "[1,2,3]", 3), (ts("2024-01-01"), 2, 2, "[4]", 1)],
        "`ym:s:dateTime` timestamp_ntz, `ym:s:clientID` int, `ym:s:visitID` int, `ym:s:watchIDs` string, `ym:s:pageViews` int",
    )
    hits = spark.createDataFrame([(1, 1, 1)], "`ym:pv:clientID` int, `ym:pv:watchID` long, `ym:pv:pageViewID` int")
    joined = join_hits(visits, hits)
    assert web_depth(visits, joined).first().bounce_rate == 0.5
    assert web_depth(visits, joined, grain="hit").first().bounce_rate == 0.25


def test_type_checks(spark):
    v4 = spark.createDataFrame([("1.2.3.255", True), ("1.2.3.256", False), ("1.2.3", False), ("01.2.3.4", True)], "a string, ok boolean")
    assert [r[0] for r in v4.select(casts.is_ipv4(F.col("a")) == F.col("ok")).collect()] == [True] * 4
    v6 = spark.createDataFrame(
        [("::", True), ("::1", True), ("1::", True), ("1:2:3:4:5:6:7:8", True), ("1:2::8", True), ("1::2::3", False), ("1:::2", False), ("1:2:3:4:5:6:7", False),
         ("1:2:3:4::5:6:7:8", False), ("g::1", False)],
        "a string, ok boolean",
    )
    assert [(r.a, r.got) for r in v6.select("a", casts.is_ipv6(F.col("a")).alias("got")).collect()] == [(r.a, r.ok) for r in v6.collect()]
    t = spark.createDataFrame([("ab",), (None,)], "v string")
    assert [r[0] for r in t.select(casts.fixed_text(F.col("v"), 3)).collect()] == ["ab ", None]
    with pytest.raises(Exception, match="longer than 1"):
        t.select(casts.fixed_text(F.col("v"), 1)).collect()
    with pytest.raises(Exception, match="unknown label ab"):
        t.select(casts.enum_code(F.col("v"), {"x": 1})).collect()
