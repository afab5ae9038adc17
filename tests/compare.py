"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        return names, result.fetchall()


def sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def same(spark_df, sql: str, sf_dir: str) -> str | None:
    """None if columns and rows agree, else the first difference."""
    names, rows = oracle_rows(sql, sf_dir)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    got = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = sorted_rows(names, rows)
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} and {w}"
    return None
