from __future__ import annotations

import math
import random
import statistics as pystat

import pytest
from pyspark.sql import functions as F

from revmill.functions import numbers
from revmill.operators import profile, quantiles
from revmill.plans import statistics


def discrete(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1] if ordered else None


def test_columns_by_type_and_name(spark):
    df = spark.createDataFrame(
        [], "id int, Customer_ID int, n int, x double, m decimal(15,2), big bigint, s string"
    )
    assert profile.numeric_columns(df.schema) == ["n", "x", "m", "big"]
    assert profile.numeric_columns(df.schema, "double_int") == ["n", "x"]
    assert profile.numeric_columns(df.schema, skip=lambda c: c != "id") == ["id"]


@pytest.mark.parametrize("exact", [False, True])
def test_profile_of_one_value_and_of_none(spark, exact):
    df = spark.createDataFrame([(5, None)], "a int, b double")
    a, b = profile.profile(df, ["a", "b"], exact).orderBy("column_name").collect()
    assert (a.min_value, a.max_value, a.mean_value, a.median_value) == (5, 5, 5, 5)
    assert a.std_deviation is None
    assert (a.count_non_null, a.count_total) == (1, 1)
    assert (b.min_value, b.median_value, b.count_non_null, b.count_total) == (None, None, 0, 1)


@pytest.mark.parametrize("exact", [False, True])
def test_profile_values(spark, exact):
    values = [1, 2, 3, 4, 100, None]
    df = spark.createDataFrame([(v,) for v in values], "a int")
    (row,) = profile.profile(df, ["a"], exact).collect()
    assert (row.min_value, row.max_value, row.median_value) == (1, 100, 3)
    assert row.std_deviation == pytest.approx(pystat.stdev([1, 2, 3, 4, 100]))
    assert (row.count_non_null, row.count_total) == (5, 6)


def test_decimals_are_left_out_of_double_int(spark):
    schema = "industry string, total_revenue decimal(15,2), customer_count int"
    df = spark.createDataFrame([], schema)
    got = statistics.column_statistics(df, "t", "double_int").collect()
    assert [r.column_name for r in got] == ["customer_count"]
    assert [r.column_name for r in statistics.column_statistics(df, "t").collect()] == [
        "total_revenue",
        "customer_count",
    ]


COLUMNS = {
    "spread": lambda i, r: r.random() * 1e6,
    "tied": lambda i, r: float(i % 3),
    "half": lambda i, r: float(i % 2),
    "hot": lambda i, r: 7.0 if i % 3 else r.random() * 14,
    "gaps": lambda i, r: None if i % 4 else r.uniform(-1, 1),
    "wide": lambda i, r: 10.0 ** r.randint(-300, 300),
    "same": lambda i, r: 3.0,
    "empty": lambda i, r: None,
}


@pytest.mark.parametrize("sortable", [0, 20, 100_000])
def test_exact_percentiles_equal_sorting(spark, sortable):
    r = random.Random(1)
    data = [tuple(make(i, r) for make in COLUMNS.values()) for i in range(5000)]
    schema = ", ".join(f"{c} double" for c in COLUMNS)
    df = spark.createDataFrame(data, schema).repartition(4)
    fractions = [0.0, 0.25, 0.5, 0.75, 1.0]
    got, _ = quantiles.exact_percentiles(df, {c: fractions for c in COLUMNS}, sortable=sortable)
    for i, c in enumerate(COLUMNS):
        assert got[c] == [discrete([row[i] for row in data], p) for p in fractions], c


def test_nth_value_of_longs_decimals_and_dates(spark):
    df = spark.range(1000).selectExpr(
        "id * 9007199254740993 AS big",
        "CAST(id AS DECIMAL(30,2)) / 100 AS money",
        "date_add(date'2000-01-01', CAST(id AS INT)) AS day",
    )
    for c in df.columns:
        want = [r[0] for r in df.select(c).orderBy(c).collect()]
        for rank in (1, 500, 1000):
            assert quantiles.nth_value(df, c, rank, sortable=10) == want[rank - 1]
        assert quantiles.nth_value(df, c, 1001) is None


def test_nth_value_of_text(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE hex(id * 7919) END AS s"
    )
    want = sorted(r[0] for r in df.where("s IS NOT NULL").collect())
    for rank in (1, 2, 777, len(want) // 2, len(want)):
        assert quantiles.nth_value(df, "s", rank) == want[rank - 1]
    assert quantiles.nth_value(df, "s", len(want) + 1) is None


def test_nan_ranks_after_all_numbers(spark):
    df = spark.range(900).selectExpr("IF(id % 3 = 0, double('NaN'), double(id)) AS x")
    low, high = quantiles.exact_percentiles(df, {"x": [0.5, 0.9]}, sortable=10)[0]["x"]
    assert low == sorted(i for i in range(900) if i % 3)[449]
    assert math.isnan(high)


def test_quartiles_of_few_rows_agree(spark):
    df = spark.range(25).select((F.col("id") * 3).alias("a"), (-F.col("id")).alias("b"))
    approx = quantiles.quartiles(df, ["a", "b"]).collect()
    assert approx == quantiles.quartiles(df, ["a", "b"], exact=True).collect()


def test_bands_are_inclusive_below_and_null_is_high(spark):
    df = spark.createDataFrame([(10,), (11,), (20,), (21,), (None,)], "v int")
    got = df.select(numbers.band(F.col("v"), 10, 20)).collect()
    assert [r[0] for r in got] == ["Low", "Mid", "Mid", "High", "High"]
    got = df.select(numbers.band(F.col("v"), 10, 20, null_category=None)).collect()
    assert got[-1][0] is None


@pytest.mark.parametrize("exact", [False, True])
def test_categories(spark, exact):
    df = spark.range(1, 9).selectExpr(
        "concat('i', id) AS industry",
        "CAST(id * 10 AS DECIMAL(15,2)) AS total_revenue",
        "9 - id AS customer_count",
    )
    got = statistics.industry_categories(df, exact).orderBy("industry").collect()
    assert [r.total_revenue_category for r in got] == ["Low"] * 2 + ["Mid"] * 4 + ["High"] * 2
    assert [r.customer_count_category for r in got] == ["High"] * 2 + ["Mid"] * 4 + ["Low"] * 2


@pytest.mark.parametrize("exact", [False, True])
def test_categories_of_no_rows_and_of_nulls(spark, exact):
    schema = "industry string, total_revenue decimal(15,2), customer_count bigint"
    assert statistics.industry_categories(spark.createDataFrame([], schema), exact).count() == 0
    nulls = spark.createDataFrame([("a", None, 1), ("b", None, 2)], schema)
    got = statistics.industry_categories(nulls, exact).collect()
    assert [r.total_revenue_category for r in got] == ["High", "High"]


def counted(spark, df, acc):
    """df, counting the rows that are read of it."""

    def run(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


def test_exact_quantiles_read_the_input_twice(spark):
    n = 60_000
    base = spark.range(n).selectExpr(
        "(id * 7919) % 60000 AS a",
        "CAST((id * 104729) % 60000 AS DECIMAL(12,2)) / 4 AS b",
        "sin(id) AS c",
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS d",
    )
    base = base.withColumn("b", F.col("b").cast("decimal(12,2)")).localCheckpoint()
    acc = spark.sparkContext.accumulator(0)
    fractions = {c: [0.25, 0.5, 0.75] for c in base.columns}
    got, _ = quantiles.exact_percentiles(counted(spark, base, acc), fractions, sortable=5)
    assert acc.value <= 2 * n
    data = base.collect()
    for c in base.columns:
        assert got[c] == [discrete([r[c] for r in data], p) for p in (0.25, 0.5, 0.75)], c


def test_sketches_are_merged_in_two_steps(spark):
    df = spark.range(0, 1000, 1, 16)
    _, sizes = quantiles._sketched(df, [(F.col("id"), df.schema["id"].dataType, [0.5])])
    assert sizes == {"n0": 1000}


def test_tables_without_numbers_and_odd_columns(spark):
    from revmill.plans import statistics

    text = spark.createDataFrame([("a",)], "s string")
    for exact in (False, True):
        assert statistics.column_statistics(text, "t", exact=exact).collect() == []
        df = spark.createDataFrame([(1.0, 2, 1e300), (3.0, 4, 1e301)], "`a.b` double, `c d` int, huge double")
        got = {r.column_name: r for r in statistics.column_statistics(df, "t", exact=exact).collect()}
        assert set(got) == {"a.b", "c d"} and float(got["a.b"].max_value) == 3 and float(got["c d"].min_value) == 2
    wide = spark.createDataFrame([(1e25,)], "x double")
    assert statistics.column_statistics(wide, "t").count() == 1
