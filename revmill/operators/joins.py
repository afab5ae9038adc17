"""Joins of large facts to dimensions that are unique on their key.

A fact key may hold any share of the rows. A dimension measured to be small is
broadcast. Otherwise the rows of each key are counted, and a key with more rows than a
task should take is spread over as many tasks as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..session import cut_lineage

# Bytes up to which a dimension is copied to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024
# Bytes per row that a hash table needs beside the values.
ROW_OVERHEAD = 32
# Rows of one key that one task takes.
TASK_ROWS = 1_000_000
# Most keys that can be hot; beyond it a key has to be larger to count as hot.
HOT_KEYS = 500_000

UNKNOWN_ACCOUNT = "unknown account"
UNKNOWN_CHANNEL = "unknown channel"
UNREADABLE = "unreadable line"


def measured_bytes(df: DataFrame) -> int:
    """The size of a table in memory, summed over its rows in one pass."""
    fixed = ROW_OVERHEAD
    text = []
    for f in df.schema:
        if isinstance(f.dataType, StringType | BinaryType):
            text.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        fixed += 8
    width = sum(text, F.lit(fixed).cast("long"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table was measured to be small enough to broadcast."""
    return measured_bytes(df) <= max_bytes


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "inner",
    spread_by: list[str] | None = None,
    max_broadcast: int | None = BROADCAST_BYTES,
    task_rows: int | None = TASK_ROWS,
) -> DataFrame:
    """Joins every fact row to its dimension row: ``how`` is inner, left, left_semi or left_anti.

    ``dim`` has one row per ``on``. Rows of a hot key are told apart by a salt from their own
    values (``spread_by``, by default the whole row), so a retried task computes the same
    salt again; only the dimension rows of hot keys are repeated. ``task_rows=None`` states
    that no key is hot and saves the count; ``max_broadcast=None`` leaves the choice to Spark,
    which knows the size of a written table without a job.
    """
    if max_broadcast is not None and fits(dim, max_broadcast):
        return _in_order(facts.join(F.broadcast(dim), on, how), facts, how)
    hot = hot_keys(facts, on, task_rows) if task_rows else None
    row = F.xxhash64(*(spread_by or facts.columns))
    # A row without a key matches nothing and may go anywhere.
    anywhere = F.when(F.col(on).isNull(), F.pmod(row, F.lit(TASK_ROWS)))
    if hot is None:
        # Always 0, but no constant: the optimizer would take a constant out of the join's
        # key, and with it the salt.
        zero = F.pmod(F.xxhash64(on), F.lit(1))
        spread = facts.withColumn("_salt", F.coalesce(anywhere, zero))
        joined = spread.join(dim.withColumn("_salt", zero), [on, "_salt"], how)
        return _in_order(joined.drop("_salt"), facts, how)
    salts = F.coalesce("_salts", F.lit(1))
    salted = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.coalesce(anywhere, F.pmod(row, salts))
    )
    repeated = dim.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    )
    joined = salted.drop("_salts").join(repeated.drop("_salts"), [on, "_salt"], how)
    return _in_order(joined.drop("_salt"), facts, how)


def hot_keys(facts: DataFrame, on: str, task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Keys with more rows than one task takes, and over how many tasks to spread them;
    None without such keys. At most HOT_KEYS keys, as each holds more than that share of
    all hot rows: a task takes at most ``task_rows`` rows of one key, or the hot rows divided
    by HOT_KEYS where those are more. The facts' key column is read once."""
    counts = facts.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_rows"))
    hot = cut_lineage(counts.where(F.col("_rows") > task_rows))
    keys, rows = hot.agg(F.count("*"), F.sum("_rows")).first()
    if not keys:
        return None
    limit = max(task_rows, rows // HOT_KEYS)
    salts: Column = F.ceil(F.col("_rows") / limit).cast("bigint").alias("_salts")
    return hot.where(F.col("_rows") > limit).select(on, salts)


def _in_order(joined: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """A filtering join leaves the columns as they were."""
    return joined.select(facts.columns) if how in ("left_semi", "left_anti") else joined


def where_in(
    df: DataFrame,
    keys: DataFrame,
    key: str,
    max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    wanted = keys.select(key).distinct()
    return lookup(df, wanted, key, "left_semi", max_broadcast=max_broadcast)


def with_facts(
    dim: DataFrame,
    facts: DataFrame,
    key: str,
    how: str = "left",
    max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """Dimension rows with their facts; ``how="left"`` keeps dimension rows without any.

    Against a large dimension and without a hot key this is a plain join. Otherwise the left
    form is the inner rows plus the unmatched dimension rows: the facts stay the streamed
    side of the join, and unmatched keys are found on distinct keys.
    """
    columns = dim.columns + [c for c in facts.columns if c != key]
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    if how == "left" and not fits(dim, max_broadcast) and hot_keys(facts, key) is None:
        return dim.join(facts, key, "left").select(columns)
    matched = lookup(facts, dim, key, max_broadcast=max_broadcast).select(columns)
    if how == "inner":
        return matched
    bare = dim.join(facts.select(key).distinct(), key, "left_anti")
    return matched.unionByName(bare, allowMissingColumns=True)


def resolve_keys(
    facts: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    spread_by: list[str] | None = None,
    max_broadcast: int | None = BROADCAST_BYTES,
    task_rows: int | None = TASK_ROWS,
) -> DataFrame:
    """Facts with ``customer_id`` looked up by ``account_id``; a fact whose account or
    channel is unknown is left out. Channels are few, so they filter first."""
    ours = facts.drop("customer_id")
    known = lookup(
        ours,
        channels.select("channel_id"),
        "channel_id",
        "left_semi",
        spread_by,
        max_broadcast,
        task_rows,
    )
    accounts = customers.select("account_id", "customer_id")
    return lookup(known, accounts, "account_id", "inner", spread_by, max_broadcast, task_rows)


def rejects(
    facts: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    spread_by: list[str] | None = None,
    max_broadcast: int = BROADCAST_BYTES,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """The facts that ``resolve_keys`` leaves out, whole, with the first reason that applies.
    ``also`` names further reasons, which come first.

    Against small dimensions the facts are read once. Against large ones the unknown keys
    are found among the distinct ones first; they are normally few, so that the facts are
    filtered and not shuffled."""
    known = {
        "account_id": customers.select("account_id"),
        "channel_id": channels.select("channel_id"),
    }
    if all(fits(dim, max_broadcast) for dim in known.values()):
        marked = facts
        for key, dim in known.items():
            seen = F.broadcast(dim.withColumn(f"_{key}", F.lit(True)))
            marked = marked.join(seen, key, "left")
        bad = {key: F.col(f"_{key}").isNull() for key in known}
    else:
        marked = facts
        for key, dim in _unknown(facts, known).items():
            marked = lookup(marked, dim, key, "left", spread_by, max_broadcast)
        bad = {key: F.col(f"_{key}").isNotNull() | F.col(key).isNull() for key in known}
    reasons = (also or {}) | {
        UNKNOWN_ACCOUNT: bad["account_id"],
        UNKNOWN_CHANNEL: bad["channel_id"],
    }
    first = F.coalesce(*[F.when(applies, F.lit(name)) for name, applies in reasons.items()])
    return (
        marked.withColumn("reason", first)
        .where(F.col("reason").isNotNull())
        .select(*facts.columns, "reason")
    )


def _unknown(facts: DataFrame, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per key column its values without a dimension row, marked; the facts are read once."""
    used = cut_lineage(facts.select(*known).distinct())
    return {
        key: cut_lineage(
            used.select(key)
            .where(F.col(key).isNotNull())
            .distinct()
            .join(dim, key, "left_anti")
            .withColumn(f"_{key}", F.lit(True))
        )
        for key, dim in known.items()
    }
