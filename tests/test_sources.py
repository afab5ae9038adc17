from __future__ import annotations

import subprocess
import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import d, rows
from revmill import model, session
from revmill.operators import aggregates, ranking, series
from revmill.plans import prices
from revmill.sources import dims, files, sinks, synthetic

ROOT = Path(__file__).parent.parent


def test_bad_values_become_null_and_keep_their_line(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "traffic_id,send_date,account_id,customer_id,channel_id,interactions_count,revenue_eur\n"
        "1,2024-01-31,1,1,1,5,1.50\n2,not a date,1,1,1,5,x\n"
    )
    got = files.read_csv(spark, str(path), model.TRAFFIC, keep_bad_rows=True).cache()
    good, bad = got.orderBy("traffic_id").collect()
    assert good.send_date == date(2024, 1, 31) and good[files.BAD_ROW] is None
    assert bad.send_date is None and bad.revenue_eur is None
    assert bad[files.BAD_ROW].startswith("2,not a date")
    plain = files.read_csv(spark, str(path), model.TRAFFIC)
    assert plain.columns == model.TRAFFIC.names and plain.count() == 2


def test_typed_text(spark):
    df = spark.createDataFrame(
        [("2024-02-30", "1.5", "k"), ("2024-02-29", "x", "k")],
        "send_date string, revenue_eur string, other string",
    )
    got = files.typed(df, model.TRAFFIC)
    assert [t for _, t in got.dtypes] == ["date", "decimal(12,2)", "string"]
    assert [r[0] for r in got.collect()] == [None, date(2024, 2, 29)]


def test_database_table_options():
    table = files.JdbcTable("jdbc:postgresql://host/db", "s.t", "user", "secret")
    assert table.options()["dbtable"] == "s.t"
    assert "secret" not in repr(table)
    split = files.Split("id", 1, 1000, 8)
    assert split.options() == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "8",
    }


def test_read_table_by_path_and_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert files.read_table(spark, path).count() == 3
    spark.range(4).createOrReplaceTempView("four_rows")
    assert files.read_table(spark, "four_rows").count() == 4


def test_sql_text_runs_its_statements(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text(
        "-- a step\nCREATE OR REPLACE TEMPORARY VIEW big AS SELECT * FROM n WHERE id > 2;\n"
        "SELECT id + :more AS id FROM big WHERE id < :top;\n"
    )
    for where in (path, str(path)):
        views, params = {"n": spark.range(9)}, {"more": 10, "top": 5}
        got = files.run_sql_file(spark, where, views, params)
        assert rows(got) == [(13,), (14,)]


SQL = ROOT / "revmill" / "plans" / "sql"


def test_catalog_tables_fill_their_defaults(spark, tmp_path):
    params = {"schema": "star_defaults", "path": str(tmp_path / "star")}
    files.run_sql_file(spark, SQL / "star.sql", {}, params)
    row = [(1, d("2024-01-31"), 7, 7, 2)]
    few = spark.createDataFrame(row, "traffic_id bigint, send_date date, account_id bigint, customer_id bigint, channel_id bigint")
    sinks.append_rows(few, "star_defaults.traffic")
    # A table that is there stays as it is.
    files.run_sql_file(spark, SQL / "star.sql", {}, params)
    sinks.append_rows(few.withColumn("revenue_eur", F.lit("2.50").cast("decimal(12,2)")), "star_defaults.traffic")
    got = files.read_table(spark, "star_defaults.traffic")
    assert sorted((r.interactions_count, str(r.revenue_eur)) for r in got.collect()) == [(0, "0.00"), (0, "2.50")]
    sinks.append_rows(spark.createDataFrame([(5,)], "customer_id bigint"), "star_defaults.customers_revenue_by_period")
    periods = files.read_table(spark, "star_defaults.customers_revenue_by_period").first()
    assert (str(periods.revenue_ytd), periods.revenue_increase_pct_qoq) == ("0.00", None)
    assert periods.last_updated is not None
    spark.sql("DROP SCHEMA star_defaults CASCADE")


def test_sql_texts_of_the_questions(spark):
    people = [(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (3, "a", "y"), (4, "c", "y")]
    sent = [(m, c, 10 * c) for c in (1, 3) for m in range(1, 13)] + [(6, 2, 10**6), (2, 4, 5), (1, 9, 10**9)]
    views = {
        "customers": spark.createDataFrame(people, "customer_id bigint, segment string, industry string"),
        "traffic": spark.createDataFrame(
            [(d(f"2023-{m:02d}-15"), c, Decimal(v)) for m, c, v in sent], "send_date date, customer_id bigint, revenue_eur decimal(12,2)"
        ),
    }
    run = lambda name, **params: [tuple(r) for r in files.run_sql_file(spark, SQL / name, views, params).collect()]
    assert run("segment_share.sql") == [("a", 2, Decimal("40.00")), ("b", 2, Decimal("40.00")), ("c", 1, Decimal("20.00"))]
    assert run("segment_changes.sql", as_of="2024-01-20", months=12) == [(3,)]
    assert run("segment_changes.sql", as_of="2024-12-16", months=12) == []
    assert run("top_customers.sql", top=2) == [(2, Decimal(10**6)), (3, Decimal(360))]
    # Four known customers of five rows: half of five is three, of which two are always active.
    assert run("always_active_top.sql", fraction="0.5", as_of="2024-01-20", months=12) == [(3, Decimal(360)), (1, Decimal(120))]
    assert run("always_active_top.sql", fraction="0.3", as_of="2024-01-20", months=12) == [(3, Decimal(360))]
    assert run("always_active_top.sql", fraction="1", as_of="2024-02-20", months=12) == []


def test_files_come_back(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, d("2024-01-01"), 'a "quoted", text')], "i int, day date, s string"
    )
    sinks.write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)
    texts = [p.read_text() for p in (tmp_path / "j").glob("part*")]
    assert '"day":"2024-01-01"' in "".join(texts)
    sinks.write_csv(df.drop("s"), str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), df.drop("s").schema)
    assert rows(back) == rows(df.drop("s"))


def test_partitioned_files(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('c', id % 3) AS company")
    for _ in range(2):
        sinks.write_partitioned(df, str(tmp_path / "p"), "company", "id")
    folders = {p.name for p in (tmp_path / "p").glob("company=*")}
    assert folders == {f"company=c{i}" for i in range(3)}
    reader = spark.read.option("header", True).schema("id bigint, company string")
    back = reader.csv(str(tmp_path / "p"))
    assert rows(back) == rows(df)


def test_describe(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int not null, c string")
    assert rows(sinks.describe_table(df)) == [
        (1, "a.b", "int", False, 0),
        (2, "c", "string", True, 1),
    ]


RESPONSE = (
    '{"Meta Data": {}, "Time Series (Daily)": {'
    '"2024-01-03": {"1. open": "3", "2. high": "4", "3. low": "2", "4. close": "x",'
    ' "5. volume": "9"},'
    '"2023-12-29": {"1. open": "1.5", "2. high": "4", "3. low": "1", "4. close": "2",'
    ' "5. volume": "7"}}}'
)


def test_daily_series(spark):
    raw = spark.createDataFrame(
        [("A", RESPONSE), ("B", '{"Note": "limit"}'), ("C", "no json"), ("D", None)],
        "company string, response string",
    )
    flat = series.flatten_daily_series(raw, "response", "company")
    assert flat.columns == ["date", *series.FIELD_NAMES, "company"]
    got = [tuple(r) for r in prices.daily_prices(raw).orderBy("date").collect()]
    assert got == [
        (date(2023, 12, 29), 1.5, 4.0, 1.0, 2.0, 7.0, "A"),
        (date(2024, 1, 3), 3.0, 4.0, 2.0, None, 9.0, "A"),
    ]
    panel = prices.price_panel(raw, raw, start="2024-01-03")
    assert [r.date for r in panel.collect()] == [date(2024, 1, 3)] * 2


def test_union_fills_missing_columns_and_counts(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x")], "n int, company string")
    b = spark.createDataFrame([("y",), (None,)], "company string")
    union = series.union_series(a, b)
    assert rows(union) == [(1, "x"), (2, "x"), (None, "y"), (None, None)]
    counts = aggregates.value_counts(union, "company").collect()
    assert [tuple(r) for r in counts] == [("x", 2), ("y", 1)]
    assert ranking.head(union, ["company", "n"], 2).count() == 2


def test_channels_and_calendar(spark):
    assert dims.channels(spark).schema == model.CHANNELS
    days = [r[0] for r in dims.calendar(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


def test_synthetic_values_do_not_depend_on_partitions(spark):
    ids = spark.range(1, 501)
    one = rows(synthetic.synth_customers(ids.coalesce(1), "id", "2024-01-01", 7))
    assert one == rows(synthetic.synth_customers(ids.repartition(13), "id", "2024-01-01", 7))
    assert one != rows(synthetic.synth_customers(ids, "id", "2024-01-01", 8))


def test_synthetic_ranges(spark):
    who = synthetic.synth_customers(spark.range(1, 2001), "id", "2024-01-01", 7).cache()
    assert who.agg(F.min("account_id"), F.max("account_id")).first() == (1, 50)
    for column, options in (("segment", 4), ("industry", 10), ("country", 10)):
        assert who.select(column).distinct().count() == options
    oldest, newest = who.agg(F.min("created_date"), F.max("created_date")).first()
    assert date(2022, 1, 1) <= oldest <= newest <= date(2024, 1, 1)

    days = dims.calendar(spark, "2023-01-01", "2024-01-01")
    sent = synthetic.synth_traffic(days, "date", 100, 7).cache()
    per_day = [r["count"] for r in sent.groupBy("send_date").count().collect()]
    assert len(per_day) == 366 and min(per_day) >= 10 and max(per_day) <= 50
    assert sent.select("traffic_id").distinct().count() == sent.count()
    checked = sent.join(dims.channels(spark), "channel_id").selectExpr(
        "revenue_eur / (interactions_count * unit_price_eur) AS factor",
        "interactions_count * unit_price_eur AS base",
    )
    low, high = checked.where("base > 10").selectExpr("min(factor)", "max(factor)").first()
    assert 0.799 < float(low) < 0.82 and 1.18 < float(high) < 1.201


def test_the_shared_folder_is_the_named_one(tmp_path):
    program = f"""
from pyspark.sql import SparkSession
from revmill.session import cut_lineage, scratch
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
first, second = scratch(spark, "x"), scratch(spark, "x")
assert first != second and first.startswith("{tmp_path}"), first
step = cut_lineage(spark.range(5))
assert step.count() == 5 and "{tmp_path}" in step.inputFiles()[0]
"""
    done = subprocess.run([sys.executable, "-c", program], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_shuffles_grow_with_the_input_and_never_shrink(spark, tmp_path, monkeypatch):
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tmp_path / "data").write_bytes(b"x" * 1000)
    assert session.size_shuffles(spark, str(tmp_path)) == before
    monkeypatch.setattr(session, "PARTITION_BYTES", 10)
    try:
        assert session.size_shuffles(spark, str(tmp_path)) == 100
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "note,customer_id,account_id,traffic_id,revenue_eur,send_date,channel_id,interactions_count\n"
        "x,77,10,1,1.50,2024-01-31,2,5\n"
    )
    row = files.read_csv(spark, str(path), model.TRAFFIC).first()
    assert row == (1, date(2024, 1, 31), 10, 77, 2, 5, row.revenue_eur) and float(row.revenue_eur) == 1.5
    path.write_text("traffic_id,send_date\n1,2024-01-31\n")
    with pytest.raises(ValueError, match="no column account_id, customer_id"):
        files.read_csv(spark, str(path), model.TRAFFIC)


def test_a_file_with_another_header_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("channel_id,channel_name,channel_type,unit_price_eur\n1,a,b,1\n")
    (tmp_path / "b.csv").write_text("channel_name,channel_id,channel_type,unit_price_eur\nb,2,b,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), model.CHANNELS).collect()


def test_a_rewritten_folder_is_seen_as_it_is(spark, tmp_path):
    from revmill.sources import star

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    assert star.table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).withColumnRenamed("id", "other").write.mode("overwrite").parquet(path)
    assert star.table(spark, str(tmp_path), "t").columns == ["other"]
