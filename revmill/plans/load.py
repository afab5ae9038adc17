"""Raw files to a checked star: surrogate keys, last-row-wins, key resolution, rejects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from ..operators import contracts, joins
from ..session import cut_lineage


class Star(NamedTuple):
    customers: DataFrame
    channels: DataFrame
    traffic: DataFrame
    raw_traffic: DataFrame

    @property
    def rejects(self) -> DataFrame:
        """Found when asked for, as it reads the raw traffic once more."""
        return joins.rejects(self.raw_traffic, self.customers, self.channels, ["seq"])


def load_customers(raw: DataFrame) -> DataFrame:
    """One customer per account: the id of its first row, the attributes of its last."""
    named = raw.withColumn("customer_id", F.col("seq"))
    return _first_id_last_values(named, "account_id", "customer_id", model.CUSTOMERS)


def load_channels(raw: DataFrame) -> DataFrame:
    """One channel per name: the id of its first row, type and price of its last."""
    return _first_id_last_values(raw, "channel_name", "channel_id", model.CHANNELS)


def _first_id_last_values(raw: DataFrame, natural: str, surrogate: str, schema) -> DataFrame:
    """First and last positions are found by hash, and only the last rows carry their text
    through a join. ``seq`` is unique."""
    rest = [f.name for f in schema if f.name not in (natural, surrogate)]
    ends = raw.groupBy(F.col(natural).alias("_natural")).agg(
        F.min("seq").alias("_first"), F.max("seq").alias("_last")
    )
    latest = raw.drop(surrogate).join(
        ends, (F.col("seq") == F.col("_last")) & F.col(natural).eqNullSafe(F.col("_natural"))
    )
    return model.conform(latest.select(natural, F.col("_first").alias(surrogate), *rest), schema)


def load_traffic(
    raw: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    max_broadcast: int | None = joins.BROADCAST_BYTES,
) -> DataFrame:
    """Accepted traffic, one row per date, account, customer and channel: the id of its first
    row, the measures of its last.

    An account has one customer, so rows with the same date, account and channel are the
    same key after resolution: they are reduced first. What is then joined holds at most
    one row per account, channel and calendar day, so no account is heavy in the join.
    """
    wanted = raw.select(
        "seq", "send_date", "account_id", "channel_id", "interactions_count", "revenue_eur"
    )
    natural = ["send_date", "account_id", "channel_id"]
    # The row that is updated keeps the id it was inserted with, that of its first row.
    rest = [F.max_by(c, "seq").alias(c) for c in ("interactions_count", "revenue_eur")]
    latest = wanted.groupBy(*natural).agg(*rest, F.min("seq").alias("traffic_id"))
    resolved = joins.resolve_keys(
        latest, customers, channels, max_broadcast=max_broadcast, task_rows=None
    )
    return model.conform(resolved, model.TRAFFIC)


def load_star(raw_customers: DataFrame, raw_channels: DataFrame, raw_traffic: DataFrame) -> Star:
    """The star of one batch. Raw frames carry ``seq``, their row order."""
    # Made once; Spark then knows their size.
    customers = cut_lineage(load_customers(raw_customers))
    channels = cut_lineage(load_channels(raw_channels))
    traffic = load_traffic(raw_traffic, customers, channels, max_broadcast=None)
    return Star(customers, channels, traffic, raw_traffic)


def check_table(name: str, df: DataFrame, schema) -> None:
    """Raises if a loaded table breaks a NOT NULL, range or size rule, in one pass."""
    rules = model.no_nulls(schema) | contracts.fit_rules(model.FIT_LIMITS.get(name, {}))
    if name == "traffic":
        rules |= contracts.not_negative("interactions_count", "revenue_eur")
    contracts.enforce(contracts.check_rules(df, rules), name)
