"""Order statistics: the built-in sketch, or exact values at any size.

Exact values are found by narrowing. A quantile sketch brackets the wanted rank, exact
counts tell where in the bracket it lies, and only rows strictly inside stay in play, until
few enough are left to sort. The table is read twice: for the sketch, and for the counts, in
the job that writes the rows inside the brackets. Later rounds read those. No task ever holds
a whole column, and a value shared by very many rows is settled by counting.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, StringType

from ..session import cut_lineage, drop_table

# Values that one task may sort.
SORTABLE = 50_000
# Buckets that sketches are merged in before they meet.
_BUCKETS = 1_024
# Sketch sizes, both good for a rank error well under the margin.
_SKETCH_K = 8_192
_ACCURACY = 10_000
_MARGIN = 1 / 1_000
# What a bucket states of a column that has no mergeable sketch.
_GRID = [(i + 0.5) / 200 for i in range(200)]
# Ranges that text values are split into at a time.
_RANGES = 128


def _ends(at: float, margin: float = _MARGIN) -> list[float]:
    return [max(0.0, at - margin), min(1.0, at + margin)]


def quoted(name: str) -> str:
    """A column name with dots or blanks, as one name."""
    return "`" + name.replace("`", "``") + "`"


def _whole(kind: DataType) -> bool:
    """Whether values are sketched as whole numbers: integers, and decimals by their digits."""
    return isinstance(kind, IntegralType) or isinstance(kind, DecimalType) and kind.precision <= 18


def _sketchable(kind: DataType) -> bool:
    return _whole(kind) or isinstance(kind, FractionalType) and not isinstance(kind, DecimalType)


def _sketch(value: Column, kind: DataType) -> Column:
    """An aggregate that sketches a column, as bytes that can be merged. Other types than
    numbers, and very long decimals, have no such sketch; percentile_approx serves them."""
    if isinstance(kind, DecimalType):
        value = value * F.lit(10**kind.scale).cast("decimal(20,0)")
    if _whole(kind):
        return F.kll_sketch_agg_bigint(value.cast("bigint"), _SKETCH_K)
    return F.kll_sketch_agg_double(value.cast("double"), _SKETCH_K)


def _merged_ends(sketch: Column, kind: DataType, ends: list[float]) -> Column:
    """An aggregate over sketches: the quantiles of all of them."""
    wanted = F.array(*[F.lit(e) for e in ends])
    if _whole(kind):
        return F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint(sketch), wanted)
    return F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(sketch), wanted)


def _back(ends: Any, kind: DataType) -> Any:
    """Quantiles as values of the column."""
    if ends is not None and isinstance(kind, DecimalType) and _whole(kind):
        return [Decimal(e).scaleb(-kind.scale) for e in ends]
    return ends


def _sketched(df: DataFrame, wanted: list[tuple[Column, DataType, list[float]]]) -> tuple[list[Any], dict[str, int]]:
    """Approximate quantiles of several columns, and their numbers of values (n0, n1, ...), in
    one pass. They need not be exact, as all use of them is confirmed by counting.

    A sketch is large, and each task of a scan makes one for each column; they are merged in
    two steps, first within buckets of tasks, so that no task receives all of them."""
    first, then = [], []
    for i, (value, kind, ends) in enumerate(wanted):
        first.append(F.count(value).alias(f"n{i}"))
        then.append(F.sum(f"n{i}").alias(f"n{i}"))
        if _sketchable(kind):
            # A bucket without values has no sketch; merging leaves NULLs out.
            first.append(F.when(F.count(value) > 0, _sketch(value, kind)).alias(f"s{i}"))
            merged = _merged_ends(F.col(f"s{i}"), kind, ends)
            then.append(F.when(F.sum(f"n{i}") > 0, merged).alias(f"e{i}"))
        else:
            first.append(F.percentile_approx(value, _GRID, _ACCURACY).alias(f"g{i}"))
    bucketed = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(_BUCKETS)).alias("_b")).agg(*first)
    others = [i for i, (_, kind, _) in enumerate(wanted) if not _sketchable(kind)]
    for i in others:
        then.append(F.collect_list(F.struct(f"n{i}", f"g{i}")).alias(f"g{i}"))
    found = bucketed.agg(*then).first().asDict()
    for i in others:
        found[f"e{i}"] = _of_grids(found[f"g{i}"], wanted[i][2])
    sizes = {f"n{i}": found[f"n{i}"] or 0 for i in range(len(wanted))}
    return [_back(found[f"e{i}"], kind) for i, (_, kind, _) in enumerate(wanted)], sizes


def _of_grids(buckets: list[Any], ends: list[float]) -> list[Any] | None:
    """Quantiles of buckets that each state a few of their own: every stated value stands for
    an equal part of its bucket. At most _BUCKETS buckets of len(_GRID) values."""
    parts = sorted((v, n / len(_GRID)) for n, grid in buckets if n for v in grid)
    total = sum(n for _, n in parts)
    out = []
    for e in ends:
        seen, value = 0.0, None
        for value, n in parts:
            seen += n
            if seen >= e * total:
                break
        out.append(value)
    return out if parts else None


@dataclass
class _Search:
    """A rank looked for in a column, of which ``inside`` rows between the exclusive
    bounds are still open and ``below`` rows lie under them."""

    column: str
    kind: DataType
    rank: int
    inside: int
    below: int = 0
    low: Any = None
    high: Any = None
    margin: float = _MARGIN
    value: Any = None
    done: bool = False

    def open_values(self) -> Column:
        value = F.col(quoted(self.column))
        if self.low is None:
            return value
        return F.when((value > F.lit(self.low)) & (value < F.lit(self.high)), value)

    def ends(self) -> list[float]:
        return _ends((self.rank - self.below) / self.inside, self.margin)

    def settle(self, value: Any) -> None:
        self.value, self.done = value, True

    def narrow(self, low: Any, high: Any, under: int, at_low: int, within: int, at_high: int):
        steps = self.rank - self.below - under
        if steps < 1 or steps > at_low + within + at_high:
            if self.margin >= 1:
                # The bracket spans all numbers, so the rank lies among the NaNs after them.
                self.settle(float("nan"))
            # The sketch missed.
            self.margin *= 4
        elif steps <= at_low:
            self.settle(low)
        elif steps > at_low + within:
            self.settle(high)
        else:
            self.below += under + at_low
            self.low, self.high, self.inside = low, high, within


def _counts(searches: list[_Search], brackets: list[list]) -> list[Column]:
    """The rows under, at and inside each bracket."""
    counts = []
    for i, (s, (low, high)) in enumerate(zip(searches, brackets)):
        value, low, high = s.open_values(), F.lit(low), F.lit(high)
        counts += [
            F.count_if(value < low).alias(f"u{i}"),
            F.count_if(value == low).alias(f"l{i}"),
            F.count_if((value > low) & (value < high)).alias(f"w{i}"),
            F.count_if((value == high) & (high > low)).alias(f"h{i}"),
        ]
    return counts


def _narrow(searches: list[_Search], brackets: list[list], found: dict[str, Any]) -> None:
    for i, s in enumerate(searches):
        s.narrow(*brackets[i], *[found[f"{name}{i}"] for name in "ulwh"])


def _sorted(searches: list[_Search]) -> list[Column]:
    """Aggregates that sort the few open rows of each search and pick its rank."""
    ranked = [F.sort_array(F.collect_list(s.open_values())) for s in searches]
    return [F.element_at(r, s.rank - s.below).alias(f"v{i}") for i, (r, s) in enumerate(zip(ranked, searches))]


def _solve(df: DataFrame, searches: list[_Search], sortable: int) -> None:
    """Rounds over a table that holds all open rows, until every search is done."""
    while large := [s for s in searches if not s.done and s.inside > sortable]:
        brackets, _ = _sketched(df, [(s.open_values(), s.kind, s.ends()) for s in large])
        _narrow(large, brackets, df.agg(*_counts(large, brackets)).first().asDict())
    small = [s for s in searches if not s.done]
    if small:
        for s, value in zip(small, df.agg(*_sorted(small)).first()):
            s.settle(value)


def _find(
    df: DataFrame, searches: list[_Search], brackets: list[list], sortable: int, also: list[Column] = ()
) -> dict[str, Any]:
    """Settles searches whose first brackets are known, and makes further aggregates, in one
    more pass over the table; what is then open is read from what that pass wrote."""
    pending = [i for i, s in enumerate(searches) if not s.done]
    small = [searches[i] for i in pending if searches[i].inside <= sortable]
    large = [i for i in pending if searches[i].inside > sortable]
    if not large:
        columns = [*_sorted(small), *also]
        found = df.agg(*columns).first().asDict() if columns else {}
        for i, s in enumerate(small):
            s.settle(found[f"v{i}"])
        return found
    wide, ends = [searches[i] for i in large], [brackets[i] for i in large]
    inside = [(s.open_values() > F.lit(e[0])) & (s.open_values() < F.lit(e[1])) for s, e in zip(wide, ends)]
    inside += [s.open_values().isNotNull() for s in small]
    # The counts come with the rows: a written job counts each of its tasks once.
    counted = Observation()
    rows = df.observe(counted, *_counts(wide, ends), *also).where(reduce(Column.__or__, inside))
    columns = list(dict.fromkeys(quoted(searches[i].column) for i in pending))
    written = cut_lineage(rows.select(*columns))
    found = counted.get
    _narrow(wide, ends, found)
    missed = [s for s in wide if not s.done and s.low is None]
    _solve(written, [s for s in [*wide, *small] if s not in missed], sortable)
    _solve(df, missed, sortable)
    drop_table(written)
    return found


def nth_value(df: DataFrame, column: str, rank: int, sortable: int = SORTABLE) -> Any:
    """The value at a 1-based ascending rank of the non-null values of a column; None
    where the rank is beyond them."""
    size = df.agg(F.count(column)).first()[0]
    if not 1 <= rank <= size:
        return None
    kind = df.schema[column].dataType
    if isinstance(kind, StringType):
        return _nth_text(df, column, rank)
    search = _Search(column, kind, rank, size)
    _solve(df, [search], sortable)
    return search.value


def _nth_text(df: DataFrame, column: str, rank: int) -> str:
    """Text has no quantile sketch. Its distinct values are counted, split into ranges, and
    only the range that holds the rank is split again."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    values = cut_lineage(values)
    while True:
        part = F.spark_partition_id().alias("_part")
        ranges = (
            values.repartitionByRange(_RANGES, column)
            .select(column, "_n", part)
            .groupBy("_part")
            .agg(F.sum("_n"), F.min(column), F.max(column))
        )
        # At most _RANGES rows; ranges with a higher number hold higher values.
        for _, rows, low, high in ranges.orderBy("_part").collect():
            if rank <= rows:
                break
            rank -= rows
        if low == high:
            return low
        values = values.where(F.col(column).between(low, high))


def exact_percentiles(
    df: DataFrame,
    wanted: dict[str, list[float]],
    sortable: int = SORTABLE,
    also: list[Column] = (),
) -> tuple[dict[str, list[Any]], dict[str, Any]]:
    """Discrete percentiles (an existing value, no interpolation) of several columns:
    the smallest value that the given fraction of the rows does not exceed. ``also`` are
    further aggregates, made in the second of the two passes and returned by name."""
    columns = [F.col(quoted(c)) for c in wanted]
    kinds = [df.schema[c].dataType for c in wanted]
    ends = [[e for p in fractions for e in _ends(p)] for fractions in wanted.values()]
    sketched, sizes = _sketched(df, list(zip(columns, kinds, ends)))
    searches, brackets = [], []
    for n, (c, fractions) in enumerate(wanted.items()):
        size = sizes[f"n{n}"]
        for i, p in enumerate(fractions):
            rank = max(1, ceil(Decimal(str(p)) * size))
            search = _Search(c, kinds[n], rank, size)
            if size == 0:
                search.settle(None)
            searches.append(search)
            brackets.append((sketched[n] or [])[2 * i : 2 * i + 2])
    found = _find(df, searches, brackets, sortable, also)
    values = iter([s.value for s in searches])
    return {c: [next(values) for _ in fractions] for c, fractions in wanted.items()}, found


def quartiles(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """One row per column with its first and third quartile, all columns in one pass."""
    if exact:
        found, _ = exact_percentiles(df, {c: [0.25, 0.75] for c in columns})
        rows = [(c, *[None if v is None else float(v) for v in found[c]]) for c in columns]
        return df.sparkSession.createDataFrame(rows, "column_name string, q1 double, q3 double")
    both = [F.percentile_approx(F.col(quoted(c)), [0.25, 0.75]).alias(f"c{i}") for i, c in enumerate(columns)]
    sketched = df.agg(*both)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"c{i}")[0].cast("double").alias("q1"),
            F.col(f"c{i}")[1].cast("double").alias("q3"),
        )
        for i, c in enumerate(columns)
    ]
    return sketched.select(F.inline(F.array(*rows)))
