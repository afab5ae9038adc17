"""The monthly run: raw files in, star, metrics, questions and statistics out.

Each step writes its tables together or not at all, and the next step reads what was
written, so a lost executor repeats tasks of one step only.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType

from .. import model
from ..operators import aggregates, contracts, joins, keys
from ..session import cut_lineage, size_shuffles
from ..sources import files, sinks
from . import load, metrics, questions, statistics

log = logging.getLogger(__name__)

PERIODS = "customers_revenue_by_period"
EXPOSURE = "business_analytics/industry_exposure"


REJECTS = StructType([*model.TRAFFIC]).add("seq", LongType()).add("reason", StringType())
# Every table the run writes, with its columns.
TABLES = {
    "customers": model.CUSTOMERS,
    "channels": model.CHANNELS,
    "traffic": StructType([*model.TRAFFIC]).add("send_month", DateType()),
    "traffic_rejects": REJECTS,
    PERIODS: model.REVENUE_BY_PERIOD,
    EXPOSURE: model.INDUSTRY_EXPOSURE,
    "business_analytics/segment_analysis": model.SEGMENT_ANALYSIS,
    "business_analytics/recent_customers": model.RECENT_CUSTOMERS,
    "business_analytics/top_customers": model.CUSTOMER_TOTALS,
    "business_analytics/monthly_active_customers": model.CUSTOMER_TOTALS,
    "descriptive_statistics/column_statistics": model.COLUMN_STATISTICS,
    "descriptive_statistics/industry_exposure_extended": model.INDUSTRY_EXPOSURE_EXTENDED,
}


def read(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{out_dir}/{name}")


def read_raw(spark: SparkSession, in_dir: str, name: str, schema: StructType) -> DataFrame:
    """A raw file with its row order, which each file states in its own id column, and
    the text of a line that does not parse."""
    rows = files.read_csv(spark, f"{in_dir}/{name}.csv", schema, keep_bad_rows=True)
    return keys.with_seq(rows, schema[0].name)


def _raise_unreadable(name: str, lines: int) -> None:
    if lines:
        raise contracts.ContractError(f"{name}: {lines} lines do not parse")


def _readable(name: str, raw: DataFrame) -> DataFrame:
    """The rows of a file, parsed once and whole, so that a bad value of any column shows."""
    parsed = cut_lineage(raw)
    _raise_unreadable(name, parsed.where(F.col(files.BAD_ROW).isNotNull()).count())
    return parsed.drop(files.BAD_ROW)


def _by_month(traffic: DataFrame) -> DataFrame:
    """Laid out by month: a date filter skips whole folders. The rebalance splits a
    heavy month over several files and gathers the rows of a small one."""
    dated = traffic.withColumn("send_month", F.trunc("send_date", "MM"))
    return dated.hint("rebalance", "send_month").sortWithinPartitions("send_month", "send_date")


def write_star(
    spark: SparkSession, in_dir: str, out_dir: str, as_of: datetime, fill_defaults: bool = False
) -> None:
    """Loads the raw files. Dimensions are written first and the traffic is resolved
    against what was written. An unreadable line, or an empty or negative value where the
    table allows none, raises and leaves the previous star in place; ``fill_defaults``
    gives empty values the column's default instead."""
    customer_rows, channel_rows = sinks.together(
        lambda: _readable("customers", read_raw(spark, in_dir, "customers", model.CUSTOMERS)),
        lambda: _readable("channels", read_raw(spark, in_dir, "channels", model.CHANNELS)),
    )
    traffic_rows = read_raw(spark, in_dir, "traffic", model.TRAFFIC)
    if fill_defaults:
        customer_rows = contracts.apply_defaults(customer_rows, {"created_date": as_of.date()})
        traffic_rows = contracts.apply_defaults(traffic_rows, model.TRAFFIC_DEFAULTS)
    unreadable = {joins.UNREADABLE: F.col(files.BAD_ROW).isNotNull()}
    with sinks.publication(spark) as tables:
        customers, channels = sinks.together(
            lambda: tables.stage(f"{out_dir}/customers", load.load_customers(customer_rows)),
            lambda: tables.stage(f"{out_dir}/channels", load.load_channels(channel_rows)),
        )
        rejected = joins.rejects(traffic_rows, customers, channels, ["seq"], also=unreadable)
        accepted = load.load_traffic(traffic_rows, customers, channels)
        left_out, traffic = sinks.together(
            lambda: tables.stage(f"{out_dir}/traffic_rejects", rejected.drop(files.BAD_ROW)),
            lambda: tables.stage(f"{out_dir}/traffic", _by_month(accepted), "send_month"),
        )
        _raise_unreadable("traffic", left_out.where(F.col("reason") == joins.UNREADABLE).count())
        sinks.together(
            lambda: load.check_table("customers", customers, model.CUSTOMERS),
            lambda: load.check_table("channels", channels, model.CHANNELS),
            lambda: load.check_table("traffic", traffic, model.TRAFFIC),
        )


def write_metrics(spark: SparkSession, out_dir: str, as_of: datetime) -> None:
    traffic = read(spark, out_dir, "traffic")
    periods = model.conform(
        metrics.revenue_by_period(traffic, as_of.date()), model.REVENUE_BY_PERIOD
    )
    sinks.upsert(f"{out_dir}/{PERIODS}", periods, ["customer_id"], as_of)


def write_questions(spark: SparkSession, out_dir: str, as_of: datetime) -> None:
    customers = read(spark, out_dir, "customers")
    traffic = read(spark, out_dir, "traffic")
    today = as_of.date()
    # The three questions on revenue share one pass over the traffic.
    activity = cut_lineage(questions.entity_activity(traffic, today))
    totals = activity.withColumnRenamed("total_revenue", "revenue_eur")
    answers = {
        EXPOSURE: (questions.industry_exposure(customers, totals), model.INDUSTRY_EXPOSURE),
        "business_analytics/segment_analysis": (
            questions.segment_share(customers),
            model.SEGMENT_ANALYSIS,
        ),
        "business_analytics/recent_customers": (
            questions.segment_changes(customers, traffic, today, month_partition="send_month"),
            model.RECENT_CUSTOMERS,
        ),
        "business_analytics/top_customers": (
            questions.top_customers(customers, totals),
            model.CUSTOMER_TOTALS,
        ),
        "business_analytics/monthly_active_customers": (
            questions.top_active(customers, activity),
            model.CUSTOMER_TOTALS,
        ),
    }
    with sinks.publication(spark) as tables:
        tables.stage_all(
            {
                f"{out_dir}/{name}": sinks.stamped(model.conform(answer, schema), as_of)
                for name, (answer, schema) in answers.items()
            }
        )


def write_statistics(spark: SparkSession, out_dir: str, as_of: datetime) -> None:
    exposure = read(spark, out_dir, EXPOSURE).drop("last_updated")
    with sinks.publication(spark) as tables:
        described, categories = sinks.together(
            lambda: statistics.column_statistics(exposure, EXPOSURE.replace("/", ".")),
            lambda: statistics.industry_categories(exposure),
        )
        categories = model.conform(categories, model.INDUSTRY_EXPOSURE_EXTENDED)
        tables.stage_all(
            {
                f"{out_dir}/descriptive_statistics/column_statistics": sinks.stamped(
                    described, as_of
                ),
                f"{out_dir}/descriptive_statistics/industry_exposure_extended": sinks.stamped(
                    categories, as_of
                ),
            }
        )


def monthly_run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    as_of: datetime,
    require_fresh: bool = False,
    fill_defaults: bool = False,
) -> DataFrame:
    """Runs every step and returns the row count of each table written. The freshness of
    the metrics is looked at before the questions; only ``require_fresh`` acts on it."""
    size_shuffles(spark, in_dir)
    write_star(spark, in_dir, out_dir, as_of, fill_defaults)
    write_metrics(spark, out_dir, as_of)
    periods = read(spark, out_dir, PERIODS)
    report = metrics.freshness(periods, "last_updated", as_of, require_fresh).first()
    log.log(logging.INFO if report["success"] else logging.WARNING, report["message"])
    write_questions(spark, out_dir, as_of)
    write_statistics(spark, out_dir, as_of)
    return aggregates.row_counts({t: read(spark, out_dir, t) for t in TABLES})
