from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import CHANNELS, CUSTOMERS, TRAFFIC, d, rows
from revmill import model
from revmill.operators import contracts, joins, keys
from revmill.plans import load, metrics, monthly
from revmill.sources import sinks

RUN = datetime(2024, 3, 15, 9)
DAY = d("2024-03-01")


def raw_customers(spark):
    return spark.createDataFrame(
        [
            (1, 10, "first", "A", "Energy", "x", DAY),
            (2, 20, "other", "B", "Media", "y", DAY),
            (3, 10, "last", "C", "Retail", "z", DAY),
        ],
        CUSTOMERS,
    )


def raw_channels(spark):
    return spark.createDataFrame(
        [(1, "SMS", "s", Decimal("0.05")), (2, "Mail", "m", Decimal("0.01"))], CHANNELS
    )


def raw_traffic(spark):
    m = Decimal
    return spark.createDataFrame(
        [
            (1, DAY, 10, 99, 1, 5, m("1.00")),
            (2, DAY, 10, 98, 1, 6, m("2.00")),  # same key after resolution: wins
            (3, DAY, 10, 97, 2, 7, m("4.00")),
            (4, DAY, 77, 1, 1, 1, m("8.00")),  # unknown account
            (5, DAY, 20, 1, 9, 1, m("16.00")),  # unknown channel
            (6, DAY, 77, 1, 9, 1, m("32.00")),  # both
            (7, DAY, None, 1, 1, 1, m("64.00")),  # no account
        ],
        TRAFFIC,
    )


def test_an_account_keeps_its_first_id_and_its_last_attributes(spark):
    got = {r.account_id: r for r in load.load_customers(raw_customers(spark)).collect()}
    assert (got[10].customer_id, got[10].customer_name, got[10].segment) == (1, "last", "C")
    assert got[20].customer_id == 2


def test_traffic_is_resolved_and_the_last_row_wins(spark):
    star = load.load_star(raw_customers(spark), raw_channels(spark), raw_traffic(spark))
    got = star.traffic.orderBy("channel_id").collect()
    assert [(r.customer_id, r.channel_id, r.interactions_count) for r in got] == [
        (1, 1, 6),
        (1, 2, 7),
    ]
    assert [r.revenue_eur for r in got] == [Decimal("2.00"), Decimal("4.00")]


def test_rejects_carry_the_first_reason(spark):
    star = load.load_star(raw_customers(spark), raw_channels(spark), raw_traffic(spark))
    got = {r.seq: r.reason for r in star.rejects.collect()}
    unknown = joins.UNKNOWN_ACCOUNT
    assert got == {4: unknown, 5: joins.UNKNOWN_CHANNEL, 6: unknown, 7: unknown}


def test_accepted_and_rejected_rows_are_the_input(spark):
    who = load.load_customers(raw_customers(spark))
    channels = load.load_channels(raw_channels(spark))
    raw = raw_traffic(spark)
    accepted = joins.resolve_keys(raw, who, channels)
    rejected = joins.rejects(raw, who, channels)
    ids = [r.seq for r in accepted.collect()] + [r.seq for r in rejected.collect()]
    assert sorted(ids) == [r.seq for r in raw.orderBy("seq").collect()]


def test_reducing_before_resolving_equals_resolving_before(spark):
    raw = spark.range(5000).selectExpr(
        "id AS seq",
        "date_add(date'2024-01-01', CAST(id % 5 AS INT)) AS send_date",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 40 END AS account_id",
        "CAST(id % 6 AS INT) AS channel_id",
        "CAST(id AS INT) AS interactions_count",
        "CAST(id AS DECIMAL(12,2)) AS revenue_eur",
    )
    who = spark.range(30).selectExpr("id AS account_id", "id + 1000 AS customer_id")
    channels = spark.createDataFrame([(i,) for i in range(5)], "channel_id int")
    natural = ["send_date", "account_id", "customer_id", "channel_id"]
    resolved = joins.resolve_keys(raw, who, channels)
    first = resolved.groupBy(*natural).agg(F.min("seq").alias("first_id"))
    late = keys.last_wins(resolved, natural).join(first, natural)
    want = rows(late.select(F.col("first_id").alias("seq"), *natural, "revenue_eur"))
    for bound in (joins.BROADCAST_BYTES, 0):
        got = load.load_traffic(raw, who, channels, max_broadcast=bound)
        got = got.select(F.col("traffic_id").alias("seq"), *natural, "revenue_eur")
        assert rows(got) == want


def test_last_wins_overwrites_also_with_null_and_with_text(spark):
    df = spark.createDataFrame(
        [(1, "k", 5, "a"), (2, "k", None, "b"), (1, "j", 7, None)],
        "seq int, k string, n int, t string",
    )
    assert rows(keys.last_wins(df, ["k"])) == [(1, "j", 7, None), (2, "k", None, "b")]
    assert rows(keys.last_wins(df.drop("t"), ["k"])) == [(1, "j", 7), (2, "k", None)]


def test_seq_follows_the_rows_of_a_file(spark, tmp_path):
    sinks.write_csv(spark.range(1000).coalesce(1), str(tmp_path / "f"))
    read = spark.read.option("header", True).schema("id bigint").csv(str(tmp_path / "f"))
    ordered = keys.with_seq(read).orderBy("seq").collect()
    assert [r.id for r in ordered] == list(range(1000))
    assert keys.with_seq(read, "id").where("seq <> id").count() == 0


def test_surrogate_keys_are_first_positions(spark):
    got = keys.first_seen_key(raw_customers(spark), ["account_id"], name="customer_id")
    assert rows(got) == [(10, 1), (20, 2)]


# Contracts


def test_unique_and_foreign_keys(spark):
    raw = raw_traffic(spark)
    assert rows(contracts.check_unique(raw, ["account_id", "channel_id"])) == [(10, 1, 2)]
    orphans = contracts.check_fk(raw, raw_customers(spark), "account_id")
    assert rows(orphans) == [(77, 2)]


def test_rules_count_false_and_not_unknown(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "revenue_eur int")
    got = contracts.check_rules(
        df,
        contracts.not_negative("revenue_eur")
        | {"revenue_eur is not null": F.col("revenue_eur").isNotNull()},
    )
    assert rows(got) == [("revenue_eur >= 0", 1), ("revenue_eur is not null", 1)]
    with pytest.raises(contracts.ContractError, match="revenue_eur >= 0: 1 rows"):
        contracts.enforce(got, "t")


def test_fit(spark):
    df = spark.createDataFrame(
        [("abc", 999.99), ("abcd", 1000.0), (None, None)], "s string, x double"
    )
    limits = {"s": 3, "x": model.FIT_LIMITS["revenue_by_period"]["revenue_increase_pct_qoq"]}
    assert rows(contracts.check_fit(df, limits)) == [
        ("s fits varchar(3)", 1),
        ("x fits decimal(5,2)", 1),
    ]


def test_defaults_keep_types(spark):
    df = spark.createDataFrame(
        [(None, None), (3, Decimal("1.50"))],
        "interactions_count int, revenue_eur decimal(12,2)",
    )
    got = contracts.apply_defaults(df, model.TRAFFIC_DEFAULTS)
    assert got.dtypes == df.dtypes
    assert rows(got) == [(0, Decimal("0.00")), (3, Decimal("1.50"))]


# Sinks


def test_replace_leaves_one_copy_and_counts_it(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.replace_table(spark.range(10), path, RUN) == 10
    assert sinks.replace_table(spark.range(4), path, RUN) == 4
    back = spark.read.parquet(path)
    assert back.count() == 4
    assert back.first().last_updated == RUN
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_keeps_the_unmatched_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    change = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    sinks.upsert(path, df, ["k"], RUN)
    assert sinks.upsert(path, change, ["k"], RUN) == 3
    want = [(1, 10), (2, 21), (3, 30)]
    assert rows(spark.read.parquet(path).drop("last_updated")) == want
    sinks.upsert(path, change, ["k"], RUN)
    assert rows(spark.read.parquet(path).drop("last_updated")) == want


def test_an_error_publishes_nothing(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    sinks.replace_table(spark.range(3), old, RUN)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        with sinks.publication(spark) as tables:
            tables.stage(old, spark.range(9))
            tables.stage(new, spark.range(9).selectExpr("id / 0 AS x"))
    assert spark.read.parquet(old).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["old"]


def test_a_failed_move_puts_everything_back(spark, tmp_path, monkeypatch):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for path in (a, b):
        sinks.replace_table(spark.range(3), path, RUN)
    move = sinks.Publication._move

    def failing(self, source, target):
        if target == b and "__staged_" in source:
            raise OSError("disk")
        move(self, source, target)

    monkeypatch.setattr(sinks.Publication, "_move", failing)
    with pytest.raises(OSError, match="disk"):
        with sinks.publication(spark) as tables:
            tables.stage(a, spark.range(9))
            tables.stage(b, spark.range(9))
    for path in (a, b):
        assert spark.read.parquet(path).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_ensure_keeps_or_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.table_exists(spark, path)
    empty = sinks.ensure_table(spark, path, model.CHANNELS)
    assert sinks.table_exists(spark, path) and not sinks.table_exists(spark, "no_such_table")
    assert empty.count() == 0
    assert [f.dataType for f in empty.schema] == [f.dataType for f in model.CHANNELS]
    row = [(1, "SMS", "SMS", Decimal("0.05"))]
    spark.createDataFrame(row, model.CHANNELS).write.mode("append").parquet(path)
    assert sinks.ensure_table(spark, path, model.CHANNELS).count() == 1
    assert sinks.ensure_table(spark, path, model.CHANNELS, replace=True).count() == 0


# The whole run


def raw_files(spark, folder, traffic):
    who = raw_customers(spark).withColumn("customer_id", F.col("seq"))
    channels = raw_channels(spark).withColumn("channel_id", F.col("seq"))
    traffic = traffic.where("account_id IS NOT NULL").withColumn("traffic_id", F.col("seq"))
    for name, df, schema in (
        ("customers", who, model.CUSTOMERS),
        ("channels", channels, model.CHANNELS),
        ("traffic", traffic, model.TRAFFIC),
    ):
        sinks.write_csv(df.select(*schema.names), f"{folder}/{name}.csv")


def test_monthly_run_and_a_second_one(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw_files(spark, raw, raw_traffic(spark))
    want = {
        "customers": 2,
        "channels": 2,
        "traffic": 2,
        "traffic_rejects": 3,
        "customers_revenue_by_period": 1,
        "business_analytics/industry_exposure": 2,
        "business_analytics/segment_analysis": 2,
        "business_analytics/recent_customers": 0,
        "business_analytics/top_customers": 1,
        "business_analytics/monthly_active_customers": 0,
        "descriptive_statistics/column_statistics": 2,
        "descriptive_statistics/industry_exposure_extended": 2,
    }
    for _ in range(2):
        got = monthly.monthly_run(spark, raw, out, RUN, require_fresh=True)
        assert {r.table_name: r.row_count for r in got.collect()} == want
    periods = spark.read.parquet(f"{out}/customers_revenue_by_period").first()
    assert periods.revenue_mtd == Decimal("6.00")


@pytest.mark.parametrize(
    "bad, message",
    [
        ("interactions_count = -1", "interactions_count >= 0: 2 rows"),
        ("revenue_eur = CAST(NULL AS STRING)", "revenue_eur is not null: 2 rows"),
        ("revenue_eur = 'n/a'", "traffic: 6 lines do not parse"),
    ],
)
def test_a_broken_rule_leaves_the_previous_star(spark, tmp_path, bad, message):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw_files(spark, raw, raw_traffic(spark))
    monthly.write_star(spark, raw, out, RUN)
    column, value = bad.split(" = ")
    raw_files(spark, raw, raw_traffic(spark).withColumn(column, F.expr(value)))
    with pytest.raises(contracts.ContractError, match=message):
        monthly.write_star(spark, raw, out, RUN)
    assert spark.read.parquet(f"{out}/traffic").agg(F.sum("revenue_eur")).first()[0] == 6
    if "NULL" in bad:
        monthly.write_star(spark, raw, out, RUN, fill_defaults=True)
        assert spark.read.parquet(f"{out}/traffic").agg(F.sum("revenue_eur")).first()[0] == 0


def test_a_month_without_traffic(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw_files(spark, raw, raw_traffic(spark).where("false"))
    got = {r.table_name: r.row_count for r in monthly.monthly_run(spark, raw, out, RUN).collect()}
    assert got["traffic"] == got["customers_revenue_by_period"] == 0
    assert got["business_analytics/industry_exposure"] == 2
    with pytest.raises(metrics.StaleError):
        monthly.monthly_run(spark, raw, out, RUN, require_fresh=True)


class Stopped(BaseException):
    """The process ends: nothing is put back."""


@pytest.mark.parametrize("stop", range(1, 10))
def test_an_interrupted_commit_is_finished_at_the_next_start(spark, tmp_path, monkeypatch, stop):
    a, b, c = (str(tmp_path / p) for p in ("a", "b", "sub/c"))
    for path in (a, b):
        sinks.upsert(path, spark.range(3).selectExpr("id AS k", "'old' AS v"), ["k"], RUN)
    move, moves = sinks.Publication._move, []

    def stopping(self, source, target):
        move(self, source, target)
        moves.append(target)
        if len(moves) == stop:
            raise Stopped

    monkeypatch.setattr(sinks.Publication, "_move", stopping)
    stopped = False
    try:
        with sinks.publication(spark) as tables:
            for path in (a, b, c):
                tables.stage(path, sinks.stamped(spark.range(5, 9).selectExpr("id AS k", "'new' AS v"), RUN))
    except Stopped:
        stopped = True
    monkeypatch.setattr(sinks.Publication, "_move", move)
    assert stopped == (stop <= 7)
    # The next start: an upsert into each table sees all old rows, or all new ones.
    states = set()
    for path in (b, a):
        sinks.upsert(path, spark.createDataFrame([(100, "late")], "k bigint, v string"), ["k"], RUN)
        states.add(tuple(r.k for r in spark.read.parquet(path).orderBy("k").collect()))
    assert len(states) == 1 and states <= {(0, 1, 2, 100), (5, 6, 7, 8, 100)}
    there = sinks.table_exists(spark, c)
    assert there == (states == {(5, 6, 7, 8, 100)})
    names = [p.name for p in tmp_path.rglob("*") if p.is_dir() or "__commit_" in p.name]
    assert not [n for n in names if "__replaced_" in n or "__commit_" in n]


@pytest.mark.parametrize("fill", [False, True])
@pytest.mark.parametrize(
    "name, column",
    [(n, f.name) for n, s in (("customers", model.CUSTOMERS), ("channels", model.CHANNELS), ("traffic", model.TRAFFIC)) for f in s if f.dataType.typeName() != "string"],
)
def test_a_bad_value_in_any_column_raises(spark, tmp_path, name, column, fill):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    texts = {
        "customers": "customer_id,account_id,customer_name,segment,industry,country,created_date\n1,10,n,s,i,c,2024-01-01\n",
        "channels": "channel_id,channel_name,channel_type,unit_price_eur\n1,SMS,SMS,0.05\n",
        "traffic": "traffic_id,send_date,account_id,customer_id,channel_id,interactions_count,revenue_eur\n1,2024-01-01,10,1,1,5,1.5\n",
    }
    header, row = texts[name].strip().split("\n")
    values = dict(zip(header.split(","), row.split(",")))
    texts[name] = f"{header}\n{row}\n{','.join(('not-it' if c == column else v) for c, v in values.items())}\n"
    for n, t in texts.items():
        (raw / f"{n}.csv").write_text(t)
    with pytest.raises(contracts.ContractError, match=f"{name}: 1 lines do not parse"):
        monthly.write_star(spark, str(raw), out, RUN, fill_defaults=fill)
    assert not sinks.table_exists(spark, f"{out}/traffic")


def test_large_money_passes_the_run(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    lines = spark.range(200).selectExpr(
        "id AS seq",
        "date_sub(date'2024-03-01', CAST(id AS INT)) AS send_date",
        "10L AS account_id",
        "1 AS channel_id",
        "1 AS interactions_count",
        "CAST(9999999999.99 AS DECIMAL(12,2)) AS revenue_eur",
    )
    raw_files(spark, raw, lines.withColumn("customer_id", F.lit(1).cast("long")))
    monthly.monthly_run(spark, raw, out, RUN)
    total = spark.read.parquet(f"{out}/business_analytics/industry_exposure").agg(F.max("total_revenue")).first()[0]
    assert total == Decimal("1999999999998.00")
    periods = spark.read.parquet(f"{out}/customers_revenue_by_period")
    report = {r.rule: r.violations for r in contracts.check_fit(periods, model.FIT_LIMITS["revenue_by_period"]).collect()}
    assert report["revenue_ytd fits decimal(12,2)"] == 1
    exposure = spark.read.parquet(f"{out}/business_analytics/industry_exposure").withColumn("total_revenue", F.col("total_revenue") * 1000)
    assert contracts.check_fit(exposure, model.FIT_LIMITS["industry_exposure"]).first().violations == 1


def test_the_updated_row_keeps_its_first_id(spark):
    star = load.load_star(raw_customers(spark), raw_channels(spark), raw_traffic(spark))
    ids = {r.traffic_id for r in star.traffic.collect()}
    resolved = joins.resolve_keys(raw_traffic(spark), star.customers, star.channels)
    natural = ["send_date", "account_id", "customer_id", "channel_id"]
    assert ids == {r.i for r in resolved.groupBy(*natural).agg(F.min("seq").alias("i")).collect()}
