"""Operators against golden values from the reference and brute-force checks on small inputs."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.operators import joins as jn
from tidewater.operators import quality as q
from tidewater.operators import sets as so
from tidewater.operators import windows as win
from tidewater.operators.sequence import ffill_within, lead_within, row_number_within


# ---------- ordered scans (skew-proof windows) ----------

def test_forward_fill_golden(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, None, 2, 3, None, None, 4])], "pos int, v int")
    out = win.forward_fill(df, [], ["pos"], "v").orderBy("pos").collect()
    assert [r.v for r in out] == [1, 1, 2, 3, 3, 3, 4]


def test_forward_fill_strict_and_zero(spark):
    df = spark.createDataFrame([(0, None), (1, 1), (2, 2)], "pos int, v int")
    with pytest.raises(Exception, match="begins without a value"):
        win.forward_fill(df.withColumn("g", F.lit(1)), ["g"], ["pos"], "v", strict=True).collect()
    z = spark.createDataFrame([(0, 5), (1, 0), (2, None)], "pos int, v int").withColumn("g", F.lit(1))
    got = win.forward_fill(z, ["g"], ["pos"], "v", treat_zero_as_missing=True).orderBy("pos").collect()
    assert [r.v for r in got] == [5, 5, 5]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_sequence_matches_window_under_skew(spark, parts):
    # one hot key with 60% of the rows, nulls in keys and values, equal order values broken by id
    rows = []
    for i in range(600):
        key = 7 if i % 5 < 3 else (None if i % 11 == 0 else i % 4)
        rows.append((i, key, i // 3, None if i % 4 == 0 else i))
    df = spark.createDataFrame(rows, "id int, k int, o int, v int")
    w = Window.partitionBy("k").orderBy("o", "id")
    ref = df.select("id", F.lead("v").over(w).alias("lead_r"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ff_r"),
                    F.row_number().over(w).alias("rn_r"))
    a = lead_within(df, ["k"], ["o", "id"], "v", "lead_x", num_partitions=parts)
    a = ffill_within(a, ["k"], ["o", "id"], "v", "ff_x", num_partitions=parts)
    a = row_number_within(a, ["k"], ["o", "id"], "rn_x", num_partitions=parts)
    bad = a.join(ref, "id").where("NOT (lead_x <=> lead_r) OR NOT (ff_x <=> ff_r) OR NOT (rn_x <=> rn_r)")
    assert a.count() == 600
    assert bad.count() == 0


def test_assign_chunk_and_ids(spark):
    names = spark.createDataFrame([(f"q{i:02d}",) for i in range(19)], "name string")
    ch = win.assign_chunk(names, ["name"], 5)
    sizes = sorted(r[1] for r in ch.groupBy("chunk").count().collect())
    assert sorted(sizes) == [4, 5, 5, 5]
    ids = win.assign_ids(names, ["name"]).orderBy("name").collect()
    assert [r.id for r in ids] == list(range(19))
    lists = win.chunk_lists(ch, "chunk", "name", "name").orderBy("chunk").collect()
    assert lists[-1]["items"] == ["q15", "q16", "q17", "q18"]


def test_retain_last_n(spark):
    df = spark.createDataFrame([("t", str(v)) for v in range(1, 106)] + [("u", "1")], "tbl string, v string")
    drop = win.retain_last_n(df, ["tbl"], "v", n=100)
    assert sorted(int(r.v) for r in drop.collect()) == [1, 2, 3, 4, 5]   # integer order, not text order
    assert win.retain_last_n(df, ["tbl"], "v", n=100, return_dropped=False).count() == 101


# ---------- joins ----------

def test_hash_join_golden(spark):
    t1 = spark.createDataFrame([(27, "Jonah"), (18, "Alan"), (28, "Glory"), (18, "Popeye"), (28, "Alan")],
                               "age int, name string")
    t2 = spark.createDataFrame([("Jonah", "Whales"), ("Jonah", "Spiders"), ("Alan", "Ghosts"), ("Alan", "Zombies"),
                                ("Glory", "Buffy")], "name string, nemesis string")
    out = jn.hash_join(t1, "name", t2, "name").collect()
    assert len(out) == 7
    assert sorted((r.left.age, r.right.nemesis) for r in out if r.left.name == "Alan") == \
        [(18, "Ghosts"), (18, "Zombies"), (28, "Ghosts"), (28, "Zombies")]
    # null keys match each other
    a = spark.createDataFrame([(1, None)], "x int, k string")
    b = spark.createDataFrame([(None, 2)], "k string, y int")
    assert jn.hash_join(a, "k", b, "k").count() == 1


def test_exclude_and_dated_names(spark):
    t = spark.createDataFrame([("table_a",), ("table_b",), ("tmp_table_c",)], "name string")
    ex = spark.createDataFrame([("table_a",)], "name string")
    assert [r.name for r in flt.exclude_names(t, "name", ex).collect()] == ["table_b"]
    assert sorted(r.name for r in flt.exclude_names(t, "name", None).collect()) == ["table_a", "table_b"]
    now = dt.datetime(2024, 5, 10, 13, 0)
    names = [f"tmp_table_{(now - dt.timedelta(days=i)).strftime('%Y%m%d_%H')}" for i in range(4)] + ["plain", "tmp_x"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in flt.dated_name_filter(df, "name", now.isoformat(sep=" ")).collect()]
    assert sorted(got) == sorted(names[1:4])


def test_alert_routing_golden(spark):
    alerts = spark.createDataFrame([("user_registration_trackings", "copy_qa", 3), ("subscription_events", "ccc", 9),
                                    ("emr_page_events", "partition_rollup_add_step", 14),
                                    ("vertica_health_check", "all_nodes_up", 22), ("other", "x", 1)],
                                   "dag_id string, task_id string, hour int")
    rules = spark.createDataFrame([("user_registration_trackings", "copy_qa", None, None),
                                   ("subscription_events", "ccc", 8, 10),
                                   ("emr_page_events", "partition_rollup_add_step", 0, 23),
                                   ("vertica_health_check", "x", None, None)],
                                  "dag_id string, task_id string, hour_from int, hour_to int")
    out = jn.alert_routing(alerts, rules, ["all_nodes_up"])
    assert sorted(r.dag_id for r in out.collect()) == sorted(["user_registration_trackings", "subscription_events",
                                                              "emr_page_events", "vertica_health_check"])


def test_override_config(spark):
    base = spark.createDataFrame([("page_events_records_ratio", 65), ("zero", 0)], "key string, value int")
    ov = spark.createDataFrame([("page_events_records_ratio", -7), ("zero", 5), ("absent", 1)], "key string, value int")
    got = dict(jn.override_config(base, ov, "key", "value").collect())
    assert got == {"page_events_records_ratio": -7, "zero": 0}


def test_insert_if_absent_and_skip(spark):
    target = spark.createDataFrame([("k1", "v1")], "k string, v string")
    new = spark.createDataFrame([("k1", "x"), ("k2", "v2"), ("k2", "v2")], "k string, v string")
    assert sorted(tuple(r) for r in jn.insert_if_absent(target, new, ["k"]).collect()) == [("k1", "v1"), ("k2", "v2")]


def test_cross_product_and_partition_values(spark):
    from tidewater.operators.catalog import partition_values
    base = spark.createDataFrame([(1,)], "x int")
    assert jn.cross_product(base, a=[1, 2, 3], b=[1, 2, 3], c=[1, 2, 3], d=[1, 2, 3]).count() == 81
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert partition_values(ids, "id", "2022-01-01").count() == 3
    assert partition_values(ids, "id", "2022-01-01", range(0, 23)).count() == 69


def test_priority_sort_and_edges(spark):
    tables = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "pos int, name string")
    prio = spark.createDataFrame([("t7",), ("t3",), ("missing",)], "name string")
    out = so.priority_sort(tables, "name", prio, "name", "pos").collect()
    assert [r.name for r in out][:3] == ["t3", "t7", "t0"]
    ch = win.assign_chunk(tables, ["pos"], 4)
    edges = jn.adjacent_chunk_edges(ch, "name", "chunk", "root")
    assert edges.where("src = 'root'").count() == 4
    assert edges.count() == 4 + 4 * 4 + 4 * 2


# ---------- aggregates ----------

def test_top_sum_and_missing(spark):
    users = [103, 105, 105, 107, 106, 103, 102, 108, 107, 103, 102]
    tips = [2, 5, 1, 0, 2, 1, 1, 0, 0, 2, 2]
    df = spark.createDataFrame(list(zip(range(len(users)), users, tips)), "pos int, user int, tip int")
    r = agg.top_sum_group(df, "user", "tip", "pos").first()
    assert (r.user, r.total) == (105, 6)
    nums = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12]], "v int")
    assert agg.missing_number_sorted(nums, "v").first()[0] == 6
    assert sorted(r[0] for r in agg.missing_values(nums, "v").collect()) == [6]


def test_missing_ranges_against_sets(spark):
    import random
    rng = random.Random(6)
    assert [tuple(r) for r in agg.missing_ranges(spark.createDataFrame([(1,), (10**15,)], "v long"), "v").collect()] == \
        [(2, 10**15 - 1, 10**15 - 2)]
    for spread in (90, 700, 10**5):
        have = [rng.randint(-spread, spread) for _ in range(300)] + [None, -64, -65, 63, 64]
        got = agg.missing_ranges(spark.createDataFrame([(v,) for v in have], "v long").repartition(5), "v", 6).collect()
        present = sorted({v for v in have if v is not None})
        assert sorted(map(tuple, got)) == [(a + 1, b - 1, b - a - 1) for a, b in zip(present, present[1:]) if b > a + 1]
    edge = [-2**63, -2**63 + 1]
    assert agg.missing_ranges(spark.createDataFrame([(e,) for e in edge], "v long"), "v").count() == 0
    assert agg.missing_ranges(spark.createDataFrame([], "v long"), "v").count() == 0
    assert agg.missing_ranges(spark.createDataFrame([(5,), (5,), (None,)], "v int"), "v").count() == 0


def test_pages_from_a_rank_directory(spark, tmp_path):
    from tidewater.operators import sets
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g")).repartition(5)
    d = sets.RankDirectory(df, f"{tmp_path}/ranks", "g", F.desc("k"), ranges=20)
    want = [tuple(r) for r in df.orderBy("g", F.desc("k")).collect()]
    for offset, limit in ((0, 10), (497, 25), (990, 50), (1000, 5), (3, 0)):
        page = d.page(offset, limit)
        assert [tuple(r) for r in page.collect()] == want[offset:offset + limit]
        assert len(d.ranges_of(offset, limit)[0]) <= 2 and sum(d.counts.values()) == 1000
    assert sets.RankDirectory(df.limit(0), f"{tmp_path}/none", "k").page(0, 5).count() == 0


def test_exact_quantiles_match_pandas(spark):
    import random
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", round(rnd.random() * 100, 1) if i % 13 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in agg.exact_quantiles(df, ["g"], "v", num_partitions=11).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    assert set(got) == set(pdf.g)
    for g, sub in pdf.groupby("g"):
        for p in agg.QUANTILES:
            assert got[g][agg.qname(p)] == pytest.approx(sub["v"].quantile(p), rel=1e-12)
    glob = agg.exact_quantiles(df, [], "v").first()
    for p in agg.QUANTILES:
        assert glob[agg.qname(p)] == pytest.approx(pdf["v"].quantile(p), rel=1e-12)


def test_quantiles_order_nan_last(spark):
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, nan, nan)], "v double")
    r = agg.exact_quantiles(df, [], "v").first()
    assert r.q05 == pytest.approx(1.2) and r.q25 == 2.0 and r.q50 == 3.0
    assert r.q75 != r.q75 and r.q95 != r.q95


def test_group_quantiles_fallback(spark):
    rows = [("big", f"o{i}", float(i)) for i in range(20)] + [("small", "o1", 1000.0), ("small", "o2", 2000.0)]
    df = spark.createDataFrame(rows, "c string, offer string, v double")
    out = {r.c: r for r in agg.group_quantiles_fallback(df, "c", "v", "offer", 10).collect()}
    pdf = pd.DataFrame(rows, columns=["c", "offer", "v"])
    assert out["big"].offers == 20 and out["small"].offers == 2
    assert out["big"].q50 == pytest.approx(pdf[pdf.c == "big"].v.quantile(0.5))
    assert out["small"].q50 == pytest.approx(pdf.v.quantile(0.5))     # global fallback


def test_case_count_and_failures(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert agg.case_count(df, F.col("a") > 5).first()[0] == -1
    assert agg.case_count(df, F.col("b").isNull()).first()[0] == 1
    s = agg.failure_summary(df, "a", F.col("b").isNull()).first()
    assert s.summary == "1 of 2"


# ---------- sets ----------

def test_set_ops(spark):
    a = spark.createDataFrame([("x/a/1",), ("x/a/2",), ("x/b/1",)], "k string")
    pre = so.distinct_prefixes(a, "k")
    assert sorted(r.prefix for r in pre.collect()) == ["x/a", "x/b"]
    dele = spark.createDataFrame([("x/a",)], "prefix string")
    assert [r.prefix for r in so.set_except(pre, dele).collect()] == ["x/b"]
    ops = spark.createDataFrame([("k", "m1", "add", 1), ("k", "m1", "remove", 2), ("k", "m2", "add", 3)],
                                "key string, value string, op string, ts int")
    st = so.keyed_set_state(ops)
    assert [r.value for r in st.collect()] == ["m2"]


# ---------- quality ----------

def test_threshold_checks_share_one_scan(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    checks = [q.Check("not_empty", df, F.count(F.lit(1)), q.GREATER_THAN, 0),
              q.Check("no_nulls", df, q.any_null_count(df, ["a", "b"]), q.LESS_THAN, 0),
              q.Check("ratio", df, F.avg("a"), q.GREATER_THAN_OR_EQUAL, 1.5)]
    res = q.threshold_checks(checks)
    got = {r.task_id: r.passed for r in res.collect()}
    assert got == {"not_empty": True, "no_nulls": False, "ratio": True}
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("Scan LocalTableScan") <= 1 or "Union" not in plan
    msgs = q.notify_messages(res, ":no_entry: {task_id} failed! Environment: *{env}*", env="prod").collect()
    assert [m.message for m in msgs] == [":no_entry: no_nulls failed! Environment: *prod*"]


def test_point_lookup(spark):
    c = spark.createDataFrame([(1, "John", "Doe"), (2, "Jane", "Doe")], "id int, first string, last string")
    assert flt.point_lookup(c, "id", 1).first().first == "John"
    assert flt.point_lookup(c, "id", 3).count() == 0
    assert flt.point_lookup_sql(c, "id", 2).first().first == "Jane"
    assert flt.point_lookup_sql(c, "id", 3).count() == 0
    ts = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2))], "id int, t timestamp_ntz")
    assert [r.id for r in flt.date_range_sql(ts, "t", "2020-01-01", "2020-01-02").collect()] == [1]
    assert [r.id for r in flt.date_range_filter(ts, "t", "2020-01-01", "2020-01-02").collect()] == [1]


def test_columns_renames(spark):
    df = spark.createDataFrame([(1, 2)], "`First Name` int, `Last Name` int")
    assert flt.sanitize_columns(df).columns == ["first_name", "last_name"]
    with pytest.raises(ValueError):
        flt.sanitize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int"))
    assert flt.rename_case(spark.createDataFrame([(1,)], "camelCaseID int")).columns == ["camel_case_i_d"]
    s = spark.createDataFrame([(1, (2, 3))], "a int, p struct<a:int, b:int>")
    assert flt.flatten_struct_column(s, "p").first().asDict() == {"a": 2, "b": 3}


def test_conditional_update(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, q double")
    out = flt.conditional_update(df, "q", float("nan"), F.col("id") == 1).orderBy("id").collect()
    assert [r.q for r in out] == [0.0, 6.0]
    assert [r.q for r in flt.conditional_update(df, "q", 3.0).collect()] == [3.0, 3.0]


def test_missing_number_beyond_doubles(spark):
    n = 200_000_002
    assert agg.missing_number_sorted(spark.range(1, n + 1).where("id <> 77777777").toDF("v"), "v").first()[0] == 77_777_777


def test_alert_routing_hours_are_the_tasks_own(spark):
    alerts = spark.createDataFrame([("d", "t1", 3), ("d", "t1", 9), ("d", "usual", 3), ("e", "usual", 3)],
                                   "dag_id string, task_id string, hour int")
    rules = spark.createDataFrame([("d", "t1", 8, 20)], "dag_id string, task_id string, hour_from int, hour_to int")
    got = {(r.dag_id, r.task_id, r.hour) for r in jn.alert_routing(alerts, rules, ["usual"]).collect()}
    assert got == {("d", "t1", 9), ("d", "usual", 3)}


def test_conditional_update_keeps_the_type(spark):
    from pyspark.sql import functions as F
    from tidewater.operators import filters as fl
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(1, big), (2, 5)], "k int, v bigint")
    out = fl.conditional_update(df, "v", float("nan"), F.col("k") == 2)
    assert dict(out.dtypes)["v"] == "bigint" and sorted(tuple(r) for r in out.collect()) == [(1, big), (2, 0)]


def test_notify_percent_and_unknown_names(spark):
    from tidewater.operators import quality
    res = spark.createDataFrame([("t", 5.0, 9.0, False)], "task_id string, value double, threshold double, passed boolean")
    assert quality.notify_messages(res, "100% of {task_id} on {env}", env="x").first().message == "100% of t on x"
    with pytest.raises(ValueError):
        quality.notify_messages(res, "{nothing}")


def test_pages_fail_loudly_and_empty_info(spark):
    from pyspark.sql import functions as F
    from tidewater.sources import api, files
    bad = spark.createDataFrame([("x", '{"0": {"a": 1}')], "tag string, page string")
    with pytest.raises(Exception):
        api.normalize_paged_result(bad, "page", "a int", ["tag"]).collect()
    row = spark.createDataFrame([(None, [])], "tstamp string, info array<struct<tstamp:string>>")
    assert str(row.select(api.event_time()).first()[0]) == "2020-01-01 00:00:00"
    ts = spark.sql("select timestamp_ntz '2024-01-01 00:00:00.123456' a, timestamp_ntz '2024-01-01 00:00:00' b")
    assert tuple(files.timestamps_to_text(ts).first()) == ("2024-01-01 00:00:00.123456", "2024-01-01 00:00:00")


def test_sketches_merge_within_their_rank_error(spark):
    import numpy as np
    from tidewater.operators import sketches as sk
    rng = np.random.default_rng(3)
    rows = [(g, int(d), float(v)) for g, size in (("a", 20_000), ("b", 3_000), (None, 50)) for d, v in
            zip(rng.integers(0, 12, size), np.round(rng.lognormal(3, 2, size), 1))]
    rows += [("a", 1, None), ("a", 1, float("nan")), ("e", 2, None), ("one", 0, 7.5)]
    df = spark.createDataFrame(rows, "g string, day int, v double").repartition(6)
    days = sk.quantile_sketches(df, ["g", "day"], "v", 0.02).cache()
    for some in (range(12), range(3, 7)):
        part = df.where(F.col("day").isin(*some))
        answers = sk.quantiles_of(sk.merge_sketches(days.where(F.col("day").isin(*some)), ["g"]), ["g"])
        errors = sk.rank_errors(part, answers, ["g"], "v").collect()
        assert len(errors) == 5 * answers.count() and max(r.error for r in errors) <= 0.02
        counted = {r.g: r.n for r in answers.collect()}
        assert counted == {g: n for g in ("a", "b", None, "one") if (n := sum(
            x[0] == g and x[1] in some and x[2] is not None and x[2] == x[2] for x in rows))}
    days.unpersist()
    assert sk.k_for(0.01) > sk.k_for(0.02) >= 8
    assert sk.quantile_sketches(df.limit(0), ["g"], "v").count() == 0
