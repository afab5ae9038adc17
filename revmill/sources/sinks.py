"""Writing files and tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import file_system
from .files import JdbcTable


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, dates in ISO form."""
    df.write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, by: str, order: str | None = None) -> None:
    """CSV in one folder per value of ``by``. Rows are gathered by value first, so there
    are few files; a value with very many rows is split over several writers."""
    gathered = df.hint("rebalance", by)
    if order:
        gathered = gathered.sortWithinPartitions(by, order)
    gathered.write.mode("overwrite").option("header", True).partitionBy(by).csv(path)


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Runs steps that do not depend on each other as concurrent jobs. All of them end before
    the first error of them is raised."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = [pool.submit(step) for step in steps]
    return [step.result() for step in running]


JOURNAL = "__commit_"


class Publication:
    """Tables written aside and put in place together. ``stage`` writes a table and
    returns it read back, so later steps neither recompute it nor see half of it.

    A commit first writes down what it is about to move, then moves. If the process ends
    in between, the next publication beside any of the tables finishes those moves, so that
    all tables are new and no old row is lost. There is one publication at a time for a set
    of tables; a reader that looks between two moves may see tables of both states."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._schemas: dict[str, StructType] = {}
        self._staged: dict[str, str] = {}
        self._run = uuid.uuid4().hex[:12]
        self._recovered: set[str] = set()

    def stage(self, path: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self._recover(path)
        aside = f"{path.rstrip('/')}__staged_{self._run}"
        self._staged[path], self._schemas[path] = aside, df.schema
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(aside)
        # A partitioned table without rows has no file to tell its columns.
        return self.spark.read.schema(df.schema).parquet(aside)

    def rows(self, path: str) -> int:
        """The rows of a table in place, counted from its file footers."""
        return self.spark.read.schema(self._schemas[path]).parquet(path).count()

    def stage_all(self, tables: dict[str, DataFrame]) -> None:
        """Stages tables that do not depend on each other, as concurrent jobs."""
        for path in tables:
            self._recover(path)
        together(*[partial(self.stage, path, df) for path, df in tables.items()])

    def _move(self, source: str, target: str) -> None:
        fs, location = file_system(self.spark, source)
        if not fs.rename(location, file_system(self.spark, target)[1]):
            raise OSError(f"cannot move {source} to {target}")

    def _there(self, path: str) -> bool:
        fs, location = file_system(self.spark, path)
        return fs.exists(location)

    def exists(self, path: str) -> bool:
        self._recover(path)
        return self._there(path)

    def _remove(self, path: str) -> None:
        fs, location = file_system(self.spark, path)
        fs.delete(location, True)

    def _write_text(self, path: str, text: str) -> None:
        """Under another name first: a file of that name is whole."""
        fs, part = file_system(self.spark, f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._move(f"{path}.part", path)

    def _journals(self, plan: dict[str, list[str]]) -> list[str]:
        """One in each folder that holds a table of the plan. The last one written, that of
        the first table, is the decision: without it the others mean nothing."""
        folders = list(dict.fromkeys(path.rstrip("/").rpartition("/")[0] for path in plan))
        return [f"{folder}/{JOURNAL}{self._run}" for folder in folders]

    def commit(self) -> None:
        """Puts every staged table in place. A move that fails puts back what was there."""
        if not self._staged:
            return
        plan = {
            path: [aside, f"{path.rstrip('/')}__replaced_{self._run}"]
            for path, aside in self._staged.items()
        }
        journals = self._journals(plan)
        text = json.dumps({"decision": journals[0], "journals": journals, "plan": plan})
        for journal in reversed(journals):
            self._write_text(journal, text)
        try:
            self._finish(plan)
        except Exception:
            self._undo(plan)
            for journal in journals:
                self._remove(journal)
            raise
        self._clear(journals, plan)

    def _finish(self, plan: dict[str, list[str]]) -> None:
        """Every move that has not been made. Can be repeated after any of them."""
        for path, (aside, old) in plan.items():
            if not self._there(aside):
                continue
            if self._there(path):
                self._move(path, old)
            self._move(aside, path)

    def _undo(self, plan: dict[str, list[str]]) -> None:
        for path, (aside, old) in plan.items():
            if not self._there(aside):
                self._move(path, aside)
            if self._there(old):
                self._move(old, path)

    def _clear(self, journals: list[str], plan: dict[str, list[str]]) -> None:
        """The decision goes last, so that an interrupted clearing is repeated."""
        for _, old in plan.values():
            self._remove(old)
        for journal in reversed(journals):
            self._remove(journal)

    def _recover(self, path: str) -> None:
        """Finishes commits that were interrupted beside this table."""
        folder = path.rstrip("/").rpartition("/")[0]
        if folder in self._recovered:
            return
        self._recovered.add(folder)
        fs, pattern = file_system(self.spark, f"{folder}/{JOURNAL}*")
        for status in fs.globStatus(pattern) or []:
            journal = status.getPath().toString()
            if journal.endswith(".part"):
                self._remove(journal)
                continue
            stream = fs.open(status.getPath())
            size = status.getLen()
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            found = json.loads(text) if size else {}
            if not found or not self._there(found["decision"]):
                self._remove(journal)
                continue
            self._finish(found["plan"])
            self._clear(found["journals"], found["plan"])

    def rollback(self) -> None:
        for aside in self._staged.values():
            self._remove(aside)


@contextmanager
def publication(spark: SparkSession) -> Iterator[Publication]:
    """All tables staged in the block appear at its end; on an error none does."""
    tables = Publication(spark)
    try:
        yield tables
    except BaseException:
        tables.rollback()
        raise
    try:
        tables.commit()
    except Exception:
        tables.rollback()
        raise


def stamped(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumn("last_updated", F.lit(as_of))


def replace_table(df: DataFrame, path: str, as_of: datetime) -> int:
    """Replaces the table's rows, stamps them with the run time and returns their number."""
    with publication(df.sparkSession) as tables:
        tables.stage(path, stamped(df, as_of))
    return tables.rows(path)


def replace_database_table(df: DataFrame, table: JdbcTable, as_of: datetime) -> None:
    """The same in a database: the table stays, with its definition, and gets new rows. Not
    all or nothing: it is emptied first and then filled by parallel connections, so a run that
    breaks off has to be repeated."""
    writer = stamped(df, as_of).write.format("jdbc").options(**table.options())
    writer.mode("overwrite").option("truncate", True).save()


def merged(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without an update, and all updates. Keys are unique on both sides,
    so no key is heavy; few updates are broadcast and the target is not shuffled."""
    untouched = target.join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(updates)


def upsert(path: str, updates: DataFrame, keys: list[str], as_of: datetime) -> int:
    """Writes the updates over the stored table by key and keeps its other rows. The new
    state is written aside first, as the old one is read while it is made."""
    spark = updates.sparkSession
    fresh = stamped(updates, as_of)
    with publication(spark) as tables:
        if tables.exists(path):
            fresh = merged(spark.read.parquet(path), fresh, keys)
        tables.stage(path, fresh)
    return tables.rows(path)


def table_exists(spark: SparkSession, ref: str) -> bool:
    """Whether a path, or a name in the catalog, holds a table."""
    return Publication(spark).exists(ref) if "/" in ref else spark.catalog.tableExists(ref)


def ensure_table(
    spark: SparkSession, path: str, schema: StructType, replace: bool = False
) -> DataFrame:
    """An existing table as it is, or a new empty one with the given columns."""
    tables = Publication(spark)
    if replace or not tables.exists(path):
        tables.stage(path, spark.createDataFrame([], schema))
        tables.commit()
    return spark.read.schema(schema).parquet(path)


def append_rows(df: DataFrame, table: str) -> None:
    """Appends rows to a table of the catalog, by column name. A column that df lacks gets the
    table's default, or NULL where it has none."""
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(
        f"INSERT INTO IDENTIFIER(:table) ({columns}) SELECT {columns} FROM {{rows}}",
        args={"table": table},
        rows=df,
    )


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, whether NULL is allowed, and how many
    NULLs there are, counted in one pass."""
    nulls = df.agg(
        *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)]
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("is_nullable"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, f in enumerate(df.schema)
    ]
    return nulls.select(F.inline(F.array(*rows)))
