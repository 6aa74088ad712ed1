import datetime as dt
import random

import numpy as np
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpanel.operators import aggregates as agg
from sparkpanel.operators import clean, dedup, joins, reshape, windows
from sparkpanel.operators.skew import group_quantiles, ordinal


def month(y, m):
    return dt.date(y, m, 1)


def by_hand(data, key, order):
    groups = {}
    for row in sorted(data, key=order):
        groups.setdefault(key(row), []).append(row)
    return {row: i + 1 for rows in groups.values() for i, row in enumerate(rows)}


def first_null(v):
    return (v is not None, v if v is not None else 0)


@pytest.mark.parametrize("width", [3, 40])
def test_ordinal_of_hot_and_null_groups(spark, width):
    data = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 7}", None if i % 50 == 0 else (i * 37) % 1009, i) for i in range(1500)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        out = ordinal(df, ["k"], ["t", "id"])
        got = {(r["k"], r["t"], r["id"]): r["rn"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == by_hand(data, lambda r: r[0], lambda r: (first_null(r[1]), r[2])) and dict(out.dtypes)["rn"] == "bigint"


def test_ordinal_by_text_with_ties(spark):
    stem = "Customer#" + "0" * 40
    data = [("hot" if i % 5 else "cold", None if i % 97 == 0 else f"{stem}{(i * 7919) % 6007:09d}é", i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, s string, id int")
    got = {(r["k"], r["s"], r["id"]): r["rn"] for r in ordinal(df, ["k"], ["s", "id"]).collect()}
    assert got == by_hand(data, lambda r: r[0], lambda r: (r[1] is not None, (r[1] or "").encode(), r[2]))
    tied = ordinal(spark.createDataFrame([("a", 1)] * 1000, "k string, v int").repartition(8), ["k"], ["v"])
    assert sorted(r["rn"] for r in tied.collect()) == list(range(1, 1001))


def test_asof_on_timestamps(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1 + h // 24, h % 24, m)
    left = spark.createDataFrame([("a", t(1)), ("a", t(30)), ("a", t(30)), ("a", t(60, 30))], "g string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", t(2), 1), ("a", t(60), 2)], "g string, ts timestamp_ntz, v int")
    got = sorted((r["ts"], r["v"] or 0) for r in joins.asof_join(left, right, "ts", ["g"], ["v"]).collect())
    assert [v for _, v in got] == [0, 1, 1, 2]


def test_quantiles_with_null_groups_and_values(spark):
    random.seed(3)
    data = [(None if i % 9 == 0 else "a" if i % 4 else "b", random.choice([None, random.random(), 0.5])) for i in range(800)] + [("c", None)]
    df = spark.createDataFrame(data, "k string, v double")
    probs = {"q1": 0.25, "med": 0.5, "q9": 0.9}
    got = {r["k"]: r for r in group_quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == {None, "a", "b", "c"} and got["c"]["med"] is None
    for k in (None, "a", "b"):
        values = [v for g, v in data if g == k and v is not None]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_merge_mm_pairs_by_position_and_repeats_the_last_row(spark, rows):
    l = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)], "k string, x int")
    r = spark.createDataFrame([("a", 10), ("a", 20), ("b", 30), ("b", 40), ("d", 50)], "k string, y int")
    want = [("a", 1, 10), ("a", 2, 20), ("a", 3, 20), ("b", 4, 30), ("b", 4, 40), ("c", 5, None), ("d", None, 50)]
    got = {tuple(t) for t in joins.merge_mm(l, r, ["k"], ["x"], ["y"]).collect()}
    assert got == set(want)


def test_merge_mm_on_unique_keys_is_a_full_join(spark):
    l = spark.createDataFrame([(i, i * 2) for i in range(0, 30, 2)], "k int, x int")
    r = spark.createDataFrame([(i, i * 3) for i in range(0, 30, 3)], "k int, y int")
    a = {tuple(t) for t in joins.merge_mm(l, r, ["k"], ["x"], ["y"]).select("k", "x", "y").collect()}
    b = {tuple(t) for t in joins.full_join(l, r, ["k"]).select("k", "x", "y").collect()}
    assert a == b


def test_merge_flag_and_checked(spark):
    l = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, x string")
    r = spark.createDataFrame([(1, "p"), (3, "q")], "k int, y string")
    got = {tuple(t) for t in joins.merge_flag(l, r, ["k"]).select("k", "x", "y", "_merge").collect()}
    assert got == {(1, "a", "p", 3), (1, "b", "p", 3), (2, "c", None, 1), (3, None, "q", 2)}
    assert joins.merge_checked(l, r, ["k"], "m:1").count() == 3
    with pytest.raises(joins.KeyNotUnique):
        joins.merge_checked(l, r, ["k"], "1:1")


def test_asof_takes_latest_snapshot_not_after(spark):
    left = spark.createDataFrame(
        [("a", month(2011, 12)), ("a", month(2012, 8)), ("a", month(2014, 2)), ("b", month(2012, 8)), ("a", month(2010, 1))], "z string, t date")
    snaps = spark.createDataFrame([("a", month(2010, 7), 1), ("a", month(2012, 4), 2), ("a", month(2012, 10), 3)], "z string, t date, p int")
    got = {(r["z"], r["t"]): r["p"] for r in joins.asof_join(left, snaps, "t", ["z"], ["p"]).collect()}
    assert got == {("a", month(2011, 12)): 1, ("a", month(2012, 8)): 2, ("a", month(2014, 2)): 3, ("b", month(2012, 8)): None, ("a", month(2010, 1)): None}
    ahead = {(r["z"], r["t"]): r["p"] for r in joins.asof_join(left, snaps, "t", ["z"], ["p"], "forward").collect()}
    assert ahead[("a", month(2010, 1))] == 1 and ahead[("a", month(2011, 12))] == 2 and ahead[("a", month(2014, 2))] is None


def test_row_lag_spans_gaps_and_calendar_lag_does_not(spark):
    df = spark.createDataFrame([("a", month(2010, 1), 1.0), ("a", month(2010, 3), 3.0), ("a", month(2010, 4), 4.0)], "e string, m date, v double")
    by_row = [r["v_lag1"] for r in windows.lag_rows(df, ["e"], "m", ["v"], 1).orderBy("m").collect()]
    by_cal = [r["v_m1"] for r in windows.lag_calendar(df, ["e"], "m", ["v"], 1).orderBy("m").collect()]
    assert by_row == [None, 1.0, 3.0] and by_cal == [None, None, 3.0]


def test_runs_first_index_and_change(spark):
    v = [0, 0, 3, 0, 0, 0, 1, 0, 0]
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate(v)] + [("b", 0, 1.0)], "e string, t int, r double")
    dry = F.col("r") == 0
    assert {r["e"]: r["longest"] for r in windows.longest_run(df, ["e"], "t", dry).collect()} == {"a": 3, "b": 0}
    first = {r["e"]: r["first"] for r in windows.first_index(df, ["e"], "t", F.col("r") > 2, 2).collect()}
    assert first == {"a": 5, "b": None}
    wet = windows.state_change(df, ["e"], "t", F.col("r") > 0).filter("e = 'a'").orderBy("t").collect()
    assert [r["change"] for r in wet] == [0, 0, 1, 0, 0, 0, 1, 0, 0]


def test_rolling(spark):
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate([5, 1, 4, 2, 3, 9])], "e string, t int, v double")
    assert [r["roll5_v"] for r in windows.rolling_sum(df, ["e"], "t", "v", 5).orderBy("t").collect()] == [None] * 4 + [15.0, 19.0]
    assert [r["med5_v"] for r in windows.rolling_median(df, ["e"], "t", "v", 5).orderBy("t").collect()] == [3.0, 3.0] + [None] * 4
    assert [r["med4_v"] for r in windows.rolling_median(df, ["e"], "t", "v", 4).orderBy("t").collect()][:3] == [3.0, 2.5, 3.5]


def series(spark, values):
    start = dt.date(2010, 1, 1)
    return spark.createDataFrame([("a", start + dt.timedelta(days=i), v) for i, v in enumerate(values)], "e string, t date, v double")


def test_linear_and_stineman_fill(spark):
    df = series(spark, [None, 1.0, None, None, 4.0, 5.0, None, 5.0, None])
    lin = [r["v"] for r in windows.interp_linear(df, ["e"], "t", "v").orderBy("t").collect()]
    assert lin == pytest.approx([1, 1, 2, 3, 4, 5, 5, 5, 5])
    st = [r["v"] for r in windows.interp_stine(df, ["e"], "t", "v").orderBy("t").collect()]
    assert None not in st and st[0] == 1.0 and st[-1] == 5.0
    assert 1 < st[2] < st[3] < 4
    straight = [r["v"] for r in windows.interp_stine(series(spark, [0.0, None, 2.0, None, 4.0]), ["e"], "t", "v").orderBy("t").collect()]
    assert straight == pytest.approx([0, 1, 2, 3, 4])


def test_fill_group_and_deviation(spark):
    df = spark.createDataFrame([("q1", 1, None), ("q1", 2, 2.0), ("q1", 3, None), ("q2", 1, 5.0), ("q2", 2, None), ("q2", 3, None)], "g string, t int, v double")
    got = [r["v"] for r in windows.fill_group(df, ["g"], "t", "v").orderBy("g", "t").collect()]
    assert got == [2.0, 2.0, 2.0, 5.0, 5.0, 5.0]
    d = spark.createDataFrame([("a", 1.0), ("a", 5.0)], "e string, v double")
    pair = {r["v"]: (r["pos_root"], r["neg_root"]) for r in windows.deviation(d, ["e"], "v").collect()}
    assert pair == {1.0: (0.0, 2.0), 5.0: (2.0, 0.0)}
    assert {r["pos_root"] for r in windows.deviation(d, ["e"], "v", legacy=True).collect()} == {0.0, 2.0}


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 2.0), ("b", 3.0), ("c", 1.0), ("c", 4.0), ("d", None)], "g string, v double")
    strict = {r["g"]: r["s"] for r in df.groupBy("g").agg(agg.sum_strict("v").alias("s")).collect()}
    assert strict == {"a": None, "b": 7.0, "c": 5.0, "d": None}
    mode = {r["g"]: r["mode"] for r in agg.mode_strict(df, ["g"], "v").collect()}
    assert mode == {"a": 1.0, "b": 2.0, "c": None, "d": None}
    part = {(r["g"], r["v"]): r["share"] for r in agg.share(df, ["g"], "v").collect()}
    assert part[("a", None)] == 0.0 and part[("d", None)] == 1.0 and part[("c", 4.0)] == 0.8
    census = {r["column"]: r["nulls"] for r in agg.null_census(df).collect()}
    assert census == {"g": 0, "v": 2}


def test_clean(spark):
    df = spark.createDataFrame([(1, 50), (2, None), (3, -4)], "k int, v int")
    assert [r["v"] for r in clean.clip(df, "v", 0, 42).orderBy("k").collect()] == [42, None, 0]
    assert [r["v"] for r in clean.clip(df, "v", 0, 42, stata_missing=True).orderBy("k").collect()] == [42, 42, 0]
    patch = spark.createDataFrame([(2, 7)], "k int, v int")
    assert [r["v"] for r in clean.override(df, ["k"], patch).orderBy("k").collect()] == [50, 7, -4]
    assert [r[0] for r in df.orderBy("k").select(clean.stata_over("v", 0)).collect()] == [True, True, False]
    z = [r["v_z"] for r in clean.zscore(df, ["v"]).orderBy("k").collect()]
    assert z[1] is None and z[0] == pytest.approx((50 - 23) / np.std([50, -4], ddof=1))


def test_dedup_and_reshape(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, t int, v string")
    assert {r["v"] for r in dedup.first_per_key(df, ["k"], ["t"]).collect()} == {"y", "z"}
    one, many = dedup.dup_split(df, ["k"])
    assert one.count() == 1 and many.count() == 2
    d = reshape.dummies(df, "k", ["a", "b", "c"])
    assert {(r["k_a"], r["k_b"], r["k_c"]) for r in d.collect()} == {(1, 0, 0), (0, 1, 0)}
    t = reshape.transpose(spark.createDataFrame([("r1", 1, 2), ("r2", 3, 4)], "r string, p int, q int"), "r", ["p", "q"], ["r1", "r2"])
    assert {tuple(r) for r in t.collect()} == {("p", 1, 3), ("q", 2, 4)}


def test_lag_calendar_keeps_the_rows(spark):
    days = [dt.date(2023, 1, d) for d in (27, 28, 29, 30, 31)] + [dt.date(2023, 2, 27), dt.date(2023, 2, 28), dt.date(2023, 3, 31)]
    df = spark.createDataFrame([("e", d, i) for i, d in enumerate(days)], "e string, m date, v int")
    got = {r["m"]: r["v_m1"] for r in windows.lag_calendar(df, ["e"], "m", ["v"], 1).collect()}
    assert len(got) == len(days) and got[dt.date(2023, 2, 27)] == 0 and got[dt.date(2023, 2, 28)] == 1 and got[dt.date(2023, 3, 31)] is None


def test_stine_does_not_depend_on_the_unit(spark):
    values = [1.0, None, None, 2.5, None, 3.0, None, None, None, 7.0]
    rows = lambda scale: [("e", dt.date(2024, 1, 1 + i), None if v is None else v * scale) for i, v in enumerate(values)]
    one, thousand = ([r["v"] for r in windows.interp_stine(spark.createDataFrame(rows(s), "e string, d date, v double"), ["e"], "d", "v").orderBy("d").collect()] for s in (1, 1000))
    assert thousand == pytest.approx([v * 1000 for v in one], rel=1e-12)
    assert one == sorted(one)
