"""Raw files, stored tables and SQL text."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD_ROW = "_bad_row"


def read_csv(
    spark: SparkSession, path: str, schema: StructType, keep_bad_rows: bool = False
) -> DataFrame:
    """CSV with a header, whose names say which column is which; types are those of
    ``schema``, without a pass for inference. Columns that ``schema`` lacks are left out, a
    missing one raises, and so does a file of the folder with another header.

    A value that does not parse becomes NULL; with ``keep_bad_rows`` its whole line is kept in
    BAD_ROW. Only the columns that a query needs are parsed, so whoever looks for bad rows
    has to read them all."""
    header = spark.read.option("header", True).csv(path).columns
    named = {name.strip().lower(): name for name in header}
    missing = [f.name for f in schema if f.name.lower() not in named]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name.lower(): f.dataType for f in schema}
    # A file promises nothing, so every column may be empty.
    fields = [StructField(h, types.get(h.strip().lower(), StringType()), True) for h in header]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_bad_rows:
        fields.append(StructField(BAD_ROW, StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    rows = reader.schema(StructType(fields)).option("enforceSchema", False).csv(path)
    wanted = [F.col(f"`{named[f.name.lower()]}`").alias(f.name) for f in schema]
    return rows.select(*wanted, *([BAD_ROW] if keep_bad_rows else []))


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Text columns to the types of ``schema``; what does not parse becomes NULL."""
    types = {f.name: f.dataType for f in schema}
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


@dataclass(frozen=True)
class JdbcTable:
    """A table in a database, with the connection given by the caller."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


@dataclass(frozen=True)
class Split:
    """How a database table is read in parallel: ranges of a numeric or date column.
    The bounds only shape the ranges; rows outside them are read as well."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_table(
    spark: SparkSession, ref: str | JdbcTable, partition_on: Split | None = None
) -> DataFrame:
    """A stored table: a database table, a parquet path, or a name in the catalog."""
    if isinstance(ref, JdbcTable):
        options = ref.options() | (partition_on.options() if partition_on else {})
        return spark.read.format("jdbc").options(**options).load()
    return spark.read.parquet(ref) if "/" in ref else spark.table(ref)


def run_sql_file(
    spark: SparkSession,
    path: str | Path,
    views: dict[str, DataFrame] | None = None,
    params: dict[str, object] | None = None,
) -> DataFrame:
    """Runs the statements of a SQL text in order and returns the last one's result.
    Each statement ends with a semicolon at the end of a line; ``params`` fill ``:name``.
    A ``Path`` is a file beside the program; a text is a location Spark can read."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    if isinstance(path, Path):
        text = path.read_text()
    else:
        text = spark.read.text(path, wholetext=True).first().value
    statements = [s for s in text.replace(";\r\n", ";\n").split(";\n") if s.strip(" ;\n")]
    result = None
    for statement in statements:
        result = spark.sql(statement.strip().rstrip(";"), args=params or {})
    if result is None:
        raise ValueError(f"no statement in {path}")
    return result
