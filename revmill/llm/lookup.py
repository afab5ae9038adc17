"""Tables of sorted 64-bit hashes in the shared folder, read by workers through memory maps.

Rows are dealt out by ranges of the hash, so that each file holds an unbroken stretch of all
hashes, and a batch's sorted distinct hashes meet each file once, from front to back. Files
hold a bounded number of rows, whatever a task receives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.llm import store

# The most files that the workers should have to open, unless the rows need more.
MOST_SHARDS = 8192
ROWS_PER_FILE = 1 << 20
FILES = "first long, addresses array<string>, n long"


@dataclass(frozen=True)
class Places:
    """The first hash and the arrays' addresses of each file, ascending."""

    first: np.ndarray
    addresses: list[list[str]]
    rows: int


def shard_count(rows: int, per_shard: int) -> int:
    return int(min(max(1, -(-rows // per_shard)), MOST_SHARDS))


def dealt(rows: DataFrame, shards: int, column: str) -> DataFrame:
    """rows with a column shard, by even ranges of the signed hash; a shard lies in one
    partition."""
    upper = F.shiftright(column, 32) + F.lit(1 << 31)
    shard = F.shiftright(upper * F.lit(shards), 32)
    return rows.withColumn("shard", shard).repartition(shards, "shard")


def written(files: DataFrame) -> Places:
    """Where the files are: one small row for each."""
    rows = sorted(files.collect(), key=lambda r: r["first"])
    first = np.array([r["first"] for r in rows], np.int64)
    return Places(first, [list(r["addresses"]) for r in rows], sum(r["n"] for r in rows))


def stretches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_FILE) -> Iterator[pa.Table]:
    """Batches of rows sorted by (shard, hash) as tables of one shard and so many rows about."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and (shard[a] != last or size >= rows):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size, last = size + b - a, shard[a]
    if held:
        yield pa.Table.from_batches(held)


def file_row(first: int, addresses: list[str], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([first], pa.int64()), pa.array([addresses], pa.list_(pa.string())), pa.array([n], pa.int64())],
        ["first", "addresses", "n"],
    )


def hash_files(folder: str, name: str, *with_it: str):
    """For mapInArrow: files of the hashes, and of the named columns (long) beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in stretches(batches):
            arrays = [table.column(c).to_numpy().astype(np.int64) for c in (name, *with_it)]
            addresses = [store.put(folder, c, array) for c, array in zip((name, *with_it), arrays)]
            yield file_row(int(arrays[0][0]), addresses, len(arrays[0]))

    return run


def found(places: Places, wanted: np.ndarray) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """For ascending distinct hashes: of each file that holds some, its addresses, which of
    the wanted hashes it has, and their rows in it."""
    if not len(places.first) or not len(wanted):
        return
    owner = np.searchsorted(places.first, wanted, side="right") - 1
    for f in np.unique(owner[owner >= 0]).tolist():
        a, b = np.searchsorted(owner, [f, f + 1])
        stored = store.mapped(places.addresses[f][0], "i8")
        at = np.minimum(np.searchsorted(stored, wanted[a:b]), len(stored) - 1)
        hit = np.flatnonzero(stored[at] == wanted[a:b])
        if len(hit):
            yield places.addresses[f], a + hit, at[hit]


def holds(places: Places, wanted: np.ndarray) -> np.ndarray:
    """Which hashes, in any order, are stored."""
    return beside(places, wanted)[0]


def beside(places: Places, wanted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which hashes, in any order, are stored, and the numbers beside them (0 if not)."""
    order = np.argsort(wanted)
    known = np.zeros(len(wanted), bool)
    columns = len(places.addresses[0]) - 1 if places.addresses else 0
    numbers = [np.zeros(len(wanted), np.int64) for _ in range(columns)]
    for addresses, which, rows in found(places, wanted[order]):
        at = order[which]
        known[at] = True
        for column, address in zip(numbers, addresses[1:]):
            column[at] = store.mapped(address, "i8")[rows]
    return known, numbers
