"""Property tests: the skew-proof ordered scans agree with a pandas reference on random data and random
partition counts; forward fill never changes non-null values; chunks partition the input."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.operators.sequence import ffill_within, lead_within, row_number_within, running_sum_within
from tidewater.operators.windows import assign_chunk

ROWS = st.lists(st.tuples(st.sampled_from([None, 0, 1, 2, 7]), st.integers(0, 5),
                          st.one_of(st.none(), st.integers(-50, 50)), st.integers(1, 4)), min_size=1, max_size=60)


def reference(rows):
    pdf = pd.DataFrame(rows, columns=["k", "o", "v", "w"])
    pdf["id"] = range(len(pdf))
    pdf = pdf.sort_values(["k", "o", "id"], na_position="first", kind="stable")
    g = pdf.groupby("k", dropna=False, sort=False)
    pdf["lead"] = g["v"].shift(-1)
    pdf["ff"] = g["v"].ffill()
    pdf["rn"] = g.cumcount() + 1
    pdf["cs"] = g["w"].cumsum()
    return pdf.set_index("id")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 9))
def test_ordered_scans_match_pandas(spark, rows, parts):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k int, o int, v int, w int")
    order = ["o", "id"]
    a = lead_within(df, ["k"], order, "v", "lead", num_partitions=parts)
    a = ffill_within(a, ["k"], order, "v", "ff", num_partitions=parts)
    a = row_number_within(a, ["k"], order, "rn", num_partitions=parts)
    a = running_sum_within(a, ["k"], order, "w", "cs", num_partitions=parts)
    got = {r.id: r for r in a.collect()}
    ref = reference(rows)
    assert len(got) == len(rows)
    for i, r in ref.iterrows():
        g = got[i]
        assert (g.lead is None and pd.isna(r.lead)) or g.lead == r.lead
        assert (g.ff is None and pd.isna(r.ff)) or g.ff == r.ff
        assert g.rn == r.rn and g.cs == r.cs
        if r.v is not None and not pd.isna(r.v):
            assert g.ff == r.v          # forward fill leaves non-null values unchanged


def test_ordered_scans_change_no_value(spark):
    far, big, nan = dt.datetime(9999, 12, 31, 23, 59, 59, 999999), 9007199254740993, float("nan")
    rows = [(i, "hot" if i % 5 else None, big + i if i % 3 else None, nan if i % 4 == 0 else (i / 2 if i % 4 == 1 else None),
             far if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, k string, b bigint, x double, t timestamp_ntz")
    a = df
    for col in ("b", "x", "t"):
        a = lead_within(a, ["k"], ["id"], col, f"lead_{col}", num_partitions=4)
        a = ffill_within(a, ["k"], ["id"], col, f"fill_{col}", num_partitions=4)
    a = row_number_within(a, ["k"], ["id"], "n", num_partitions=4)
    show = lambda v: "nan" if v != v else v
    got = {r.id: r for r in a.collect()}
    assert len(got) == len(rows)
    for key in ("hot", None):
        group = [r for r in rows if r[1] == key]
        fill = [None] * 3
        for i, r in enumerate(group):
            g = got[r[0]]
            following = group[i + 1][2:] if i + 1 < len(group) else (None,) * 3
            fill = [v if v is not None else f for v, f in zip(r[2:], fill)]
            assert [show(v) for v in (g.b, g.x, g.t)] == [show(v) for v in r[2:]]
            assert [show(v) for v in (g.lead_b, g.lead_x, g.lead_t)] == [show(v) for v in following]
            assert [show(v) for v in (g.fill_b, g.fill_x, g.fill_t)] == [show(v) for v in fill]
            assert g.n == i + 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 40), size=st.integers(1, 7))
def test_chunks_partition_the_input(spark, n, size):
    df = spark.createDataFrame([(i,) for i in range(n)], "x int")
    ch = assign_chunk(df, ["x"], size).collect()
    assert sorted(r.x for r in ch) == list(range(n))
    counts = pd.Series([r.chunk for r in ch]).value_counts().sort_index()
    assert list(counts.index) == list(range(len(counts)))
    assert all(c == size for c in counts.iloc[:-1]) and 1 <= counts.iloc[-1] <= size
