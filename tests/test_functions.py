"""Scalar functions against the reference's stated and derived golden values (FIXTURES.md part A)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidewater.functions as tf
from tidewater.functions.strings import camel_name, snake_name


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_case_conversion(spark):
    assert one(spark, tf.camel_to_snake("s"), [("camelCaseID",), ("simple",)], "s string") == \
        ["camel_case_i_d", "simple"]
    assert one(spark, tf.snake_to_camel("s"), [("snake_case_name",), ("a1b_c2d",), ("x",)], "s string") == \
        ["snakeCaseName", "a1bC2D", "x"]


def test_preplace(spark):
    out = one(spark, tf.preplace("s", "alpha", "_"), [("abcalphacdealphaxalph",)], "s string")
    assert out == ["abc_alphacde_alphaxalph"]
    # the two forms differ on overlapping occurrences
    assert one(spark, tf.preplace("s", "aa", "_"), [("aaa",)], "s string") == ["_aaa"]
    assert one(spark, tf.preplace("s", "aa", "_", overlapping=True), [("aaa",)], "s string") == ["_a_aa"]
    with pytest.raises(ValueError):
        tf.preplace("s", "", "_")


def test_count_char(spark):
    s = "ss ccbbb ddsss obnsd kljsn dg"
    df = spark.createDataFrame([(s,), ("",)], "s string")
    got = df.select(tf.count_char("s", " "), tf.count_char("s", "k"), tf.count_char("s", "b"),
                    tf.count_char("s", "s"), tf.count_char("s", "q")).collect()
    assert tuple(got[0]) == (5, 1, 4, 7, 0)
    assert got[1][4] == 0


def test_path_segment_and_hash_bucket(spark):
    assert one(spark, tf.path_segment("p"), [("/a/b/c/d/e",), ("/a/b/c/d/",), ("a/b",)], "p string") == \
        ["d", "d", "b"]
    rows = spark.createDataFrame([("object:12345",), ("object:7",)], "k string") \
        .select(tf.hash_bucket("k").alias("b")).collect()
    assert (rows[0].b.key, rows[0].b.field) == ("object:123", "45")
    assert (rows[1].b.key, rows[1].b.field) == ("object:", "7")


def test_concat_nonempty(spark):
    df = spark.createDataFrame([(1, "John", dt.date(1975, 6, 30)), (1, "Jane", None)], "id int, name string, dbo date")
    assert one(spark, tf.concat_nonempty(["id", "name", "dbo"]), df.collect(), df.schema) == \
        ["id:1;name:John;dbo:1975-06-30", "id:1;name:Jane"]


STRIP_CASES = [
    (None, "/"), ("", "/"), ("dbr", "dbr/"), ("active_campaign", "active_campaign/"), ("test_dbr", "dbr/"),
    ("poc_dbr", "dbr/"), ("for_sapi", "for_sapi/"), ("test_for_sapi", "for_sapi/"), ("poc_for_sapi", "for_sapi/"),
    ("dbr/", "dbr/"), ("test_dbr/", "dbr/"), ("poc_dbr/", "dbr/"), ("for_sapi/", "for_sapi/"),
    ("test_for_sapi/", "for_sapi/"), ("poc_for_sapi/", "for_sapi/"),
    ("dbr/mp_kpi_dash_interim", "dbr/mp_kpi_dash_interim/"),
    ("test_dbr/mp_kpi_dash_interim", "dbr/mp_kpi_dash_interim/"),
    ("poc_dbr/mp_kpi_dash_interim", "dbr/mp_kpi_dash_interim/"),
    ("for_sapi/mp_kpi_dash_interim", "for_sapi/mp_kpi_dash_interim/"),
    ("test_for_sapi/mp_kpi_dash_interim", "for_sapi/mp_kpi_dash_interim/"),
    ("poc_for_sapi/mp_kpi_dash_interim", "for_sapi/mp_kpi_dash_interim/"),
]


def test_strip_env_prefix(spark):
    got = one(spark, tf.strip_env_prefix("p", ["active_campaign", "for_sapi"]), [(c,) for c, _ in STRIP_CASES],
              "p string")
    assert got == [e for _, e in STRIP_CASES]


def _ts(spark, values):
    return spark.createDataFrame([(dt.datetime.fromisoformat(v),) for v in values], "t timestamp_ntz")


def test_previous_daily_run(spark):
    df = _ts(spark, ["2020-04-20 05:25:00", "2020-04-20 16:25:00", "2020-04-20 04:25:00"])
    got = [r[0] for r in df.select(tf.previous_daily_run("t")).collect()]
    assert got == [dt.datetime(2020, 4, 19, 5, 25), dt.datetime(2020, 4, 19, 5, 25), dt.datetime(2020, 4, 18, 5, 25)]


def test_previous_slot(spark):
    df = _ts(spark, [f"2020-04-22 {h:02d}:25:00" for h in range(7)])
    got = [r[0] for r in df.select(tf.previous_slot("t", [1, 4, 5, 6, 9, 13, 17, 21])).collect()]
    want = [dt.datetime(2020, 4, 21, 23, 25), dt.datetime(2020, 4, 22, 1, 25), dt.datetime(2020, 4, 22, 1, 25),
            dt.datetime(2020, 4, 22, 1, 25), dt.datetime(2020, 4, 22, 4, 25), dt.datetime(2020, 4, 22, 5, 25),
            dt.datetime(2020, 4, 22, 6, 25)]
    assert got == want


def test_throttle_and_clamp(spark):
    start = dt.datetime(2020, 4, 22, 0, 25)
    df = spark.createDataFrame([(start + dt.timedelta(minutes=5 * i), start) for i in range(5)],
                               "t timestamp_ntz, last timestamp_ntz")
    assert [r[0] for r in df.select(tf.throttle_ok("t", "last")).collect()] == [False, False, False, True, True]
    c = _ts(spark, ["2020-01-01 10:00:00", "2020-05-20 10:00:00"]).select(tf.clamp_past("t", "2020-06-01 00:00:00"))
    assert [r[0] for r in c.collect()] == [dt.datetime(2020, 5, 1, 10, 0), dt.datetime(2020, 5, 20, 10, 0)]


def test_zone_and_epoch(spark):
    df = _ts(spark, ["2021-03-14 07:25:00"])
    r = df.select(tf.to_zone("t", "America/New_York"), tf.format_zone_date("t"),
                  tf.iso_to_epoch(F.lit("2021-03-14T02:25:00Z")), tf.iso_to_epoch(F.lit("bad"))).first()
    assert r[0] == dt.datetime(2021, 3, 14, 3, 25)   # EDT started at 02:00 local
    assert r[1] == "2021-03-14"
    assert r[2] == 1615688700
    assert r[3] is None


def test_arrays(spark):
    df = spark.createDataFrame([([2, 3, 5, 1], [0, 2, 3], ["1", "2", "3"])], "a array<int>, b array<int>, s array<string>")
    r = df.select(tf.product_except_self("a"), tf.product_nonzero("b"), tf.double_elements("a", T.IntegerType()),
                  tf.double_elements("s", T.StringType()), tf.flat_map("a", lambda x: F.array(x, x))).first()
    assert r[0] == [15, 10, 6, 30]
    assert r[1] == 6
    assert r[2] == [4, 6, 10, 2]
    assert r[3] == ["11", "22", "33"]
    assert r[4] == [2, 2, 3, 3, 5, 5, 1, 1]


def test_factorial_and_divide(spark):
    df = spark.createDataFrame([(5, 7, 2), (1, -7, 2), (0, 7, -2)], "n int, a int, b int")
    r = df.select(tf.factorial_parity("n"), tf.divide_trunc("a", "b")).collect()
    assert [x[0] for x in r] == [120, 1, 0]
    assert [x[1] for x in r] == [3, -3, -3]
    with pytest.raises(Exception):
        spark.createDataFrame([(1, 0)], "a int, b int").select(tf.divide_trunc("a", "b")).collect()
    assert spark.createDataFrame([(1, 0)], "a int, b int").select(tf.divide_trunc("a", "b", "null")).first()[0] is None


def test_map_merge_right_wins(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS l, map('b', 20, 'c', 30) AS r")
    assert df.select(tf.map_merge("l", "r")).first()[0] == {"a": 1, "b": 20, "c": 30}


def test_key_date(spark):
    keys = ["db/t/date_=2021-01-05/part-0.parquet", "db/t/date_=2021-01-05T10:00:00/x", "db/t/date_2021-01-05-10-30/x",
            "db/t/undated/x", "db/t/date_=garbage/x"]
    got = one(spark, tf.key_date("k"), [(k,) for k in keys], "k string")
    assert got == [dt.date(2021, 1, 5)] * 3 + [None, None]


def test_capacity_percent(spark):
    df = spark.createDataFrame([("Raw data size: 5.00TB +/- 0.1TB\nLicense size: 10TB", 512)], "r string, e int")
    # used 5120 GB - 512 external = 4608 of 10240 -> 45 %
    assert df.select(tf.capacity_percent("r", "e")).first()[0] == 45


def test_json_functions(spark):
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("students", T.ArrayType(T.StructType([
                               T.StructField("first_name", T.StringType()), T.StructField("age", T.IntegerType())]))),
                           T.StructField("meta", T.StructType([T.StructField("x", T.StringType())])),
                           T.StructField("tags", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([(("team", [("ann", None), (None, None)], (None,), []),), ((None, [], None, None),)],
                               T.StructType([T.StructField("d", schema)]))
    out = [r[0] for r in df.select(tf.to_json_compact("d", schema)).collect()]
    assert out == ['{"name":"team","students":[{"first_name":"ann"}]}', "[]"]
    rt = df.select(tf.json_round_trip("d", schema).alias("x"), F.col("d")).collect()
    assert rt[0].x == rt[0].d
    assert spark.sql("SELECT 1").select(tf.parse_json_text(F.lit('{"k": 1}'))).first()[0] == '{"k":1}'


def test_polygon(spark):
    ring = "[[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [1.0, 2.0]]"
    df = spark.createDataFrame([(ring,), ("[" + ring + "]",), ("[[1.0, 2.0], [3.0, 4.0]]",)], "c string")
    r = df.select(tf.polygon_wkt(tf.polygon_ring("c")), tf.polygon_valid(tf.polygon_ring("c"))).collect()
    assert r[0][0] == "POLYGON((2.0 1.0,4.0 3.0,6.0 5.0,2.0 1.0))"
    assert r[1][0] == r[0][0]
    assert [x[1] for x in r] == [True, True, False]


def test_names_follow_the_column_functions(spark):
    names = ["camelCaseID", "simple", "A", "aB", "ÄrgerÖl", "x1Y2", "snake_case_name", "a1b_c2d", "_lead", "x__y", "ab_CD"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = df.select("s", tf.camel_to_snake("s").alias("snake"), tf.snake_to_camel("s").alias("camel")).collect()
    for r in got:
        assert (r.snake, r.camel) == (snake_name(r.s), camel_name(r.s))
    assert {r.s: r.snake for r in got}["ÄrgerÖl"] == "ärgeröl" and {r.s: r.camel for r in got}["ab_CD"] == "abCd"


def test_product_except_self_with_zeros_nulls_and_large_numbers(spark):
    from math import prod
    rows = [[], [7], [None], [2, 3], [0, 4, 5], [0, 4, 0], [2, None, 3], [None, None, 3], [None, 0, 3], [-2, 3, -4],
            [10**10] * 3, [10**10, 10**8, 5], [2] * 62, list(range(1, 300))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<bigint>")
    got = {r.i: r.p for r in df.select("i", tf.product_except_self("a").alias("p")).collect()}
    for i, a in enumerate(rows):
        want = a if len(a) <= 1 else []
        if len(a) > 1:
            for k in range(len(a)):
                rest = a[:k] + a[k + 1:]
                p = None if None in rest else prod(rest)
                want.append(p if p is not None and abs(p) < 2**63 else None)
        assert got[i] == want


def test_url_parts_are_decoded(spark):
    from tidewater.operators import filters as flt
    urls = ["postgresql://us%40er:p%3Aw+%2Fx@h.example:5432/d%20b?a=1%262&b=x+y", "s3://bucket/key", "mysql://u@h/", "x://u:@h",
            "x://h/50%zz"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(flt.url_parts("u").alias("p")).select("p.*").collect()
    assert [(r.user, r.password, r.host, r.port, r.path) for r in got] == [
        ("us@er", "p:w+/x", "h.example", 5432, "/d b"), (None, None, "bucket", None, "/key"), ("u", None, "h", None, "/"),
        ("u", "", "h", None, ""), (None, None, "h", None, "/50%zz")]
    assert got[0].query == {"a": "1&2", "b": "x y"}
