"""Metadata operators: type mapping, table definitions, catalog type text, schema comparison and evolution."""

from tidewater.operators import catalog as cat
from tidewater.operators import joins as jn

COLS = [("t1", "id", "bigint", "", 1, "PRI"), ("t1", "price", "decimal", "(12,2)", 3, ""),
        ("t1", "name", "varchar", "255", 2, "UNI"), ("t1", "ts", "precision_datetime", "", 4, ""),
        ("t1", "odd", "geometry", "", 5, ""), ("t2", "code", "char", "3", 1, "PRI")]
SCHEMA = "table_name string, name string, data_type string, data_length string, ordinal_position int, column_key string"


def test_map_types(spark):
    got = {r.name: (r.catalog_type, r.warehouse_type) for r in
           cat.map_types(spark.createDataFrame(COLS, SCHEMA)).collect()}
    assert got["id"] == ("bigint", "BIGINT")
    assert got["name"] == ("string", "VARCHAR")
    assert got["ts"] == ("precision_timestamp", "TIMESTAMP")
    assert got["odd"] == (None, None)


def test_table_defs_and_render(spark):
    df = spark.createDataFrame(COLS, SCHEMA)
    d = {r.table_name: r for r in cat.table_defs_from_columns(df).collect()}
    assert [c.name for c in d["t1"].columns] == ["id", "name", "price", "ts", "odd"]
    assert [k.name for k in d["t1"].primary_keys] == ["id"]
    assert [k.name for k in d["t1"].unique_keys] == ["name"]
    assert d["t1"].table_type == "EXTERNAL_TABLE" and d["t1"].classification == "mysql"
    types = {r.name: r.type_text for r in cat.render_column_types(df).collect()}
    assert types["price"] == "decimal(12,2)"        # one pair of brackets
    assert types["name"] == "string"                 # strings carry no length
    assert types["code"] == "char(3)"
    assert types["id"] == "bigint"


def test_compare_file_schema(spark):
    f = spark.createDataFrame([(0, "id", "long"), (1, "n", "integer"), (2, "x", "string")],
                              "row_num int, name string, type string")
    c = spark.createDataFrame([(0, "id", "bigint"), (1, "n", "bigint"), (2, "y", "string")],
                              "row_num int, name string, type string")
    got = {r.name: r.status for r in cat.compare_file_schema(f, c).collect()}
    assert got == {"id": "same", "n": "type_differs", "x": "missing_in_catalog", "y": "missing_in_file"}


def test_evolve_and_schema_diff(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", 3.0)], "id int, v string, extra double")
    out = cat.evolve_schema(old, new)
    assert out.columns == ["id", "v", "extra"]
    assert sorted((r.id, r.extra) for r in out.collect()) == [(1, None), (2, 3.0)]
    saved = spark.createDataFrame([("a", [1, 2]), ("b", [1]), ("c", [5])], "name string, cols array<int>")
    cur = spark.createDataFrame([("a", [2, 1]), ("b", [2]), ("d", [1])], "name string, cols array<int>")
    got = dict(jn.schema_diff(saved, cur).collect())
    assert got == {"a": "skip", "b": "update", "c": "create", "d": "drop"}
