"""Packs tokenised documents into sequences of a fixed length by bin completion.

Pieces of equal length are interchangeable, so the search runs on the histogram of lengths,
which has at most `capacity` rows however many documents there are. A packing plan is a list
of patterns (a multiset of lengths, and how many sequences repeat it); pieces then take their
places in it by their rank within their length, which is counted in a distributed way.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm.bpe import encoder
from revmill.llm.common import numbered, ship, text_of
from revmill.session import cut_lineage

# Search nodes of the branch and bound for each distinct length, and at least. A branch has
# about one node for each distinct length.
NODES = 4
LEAST_NODES = 5000

Pattern = tuple[dict[int, int], int]  # how often each length occurs, number of sequences


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the token ids of each whole text,
    then end_id, cut if longer than capacity.

    Cut pieces hold capacity tokens each, only the first may be shorter. A null text is
    empty: it has the end id alone, or no piece if there is none. Repeated rows give repeated
    pieces. Other columns are left out.
    """
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, counts, ids in enc.encode(texts):
                ids = ids.astype("<u4")
                edges = np.concatenate(([0], np.cumsum(counts)))
                rows, piece, start, length, crc, lists = [], [], [], [], [], []
                for i in range(len(counts)):
                    own = ids[edges[i] : edges[i + 1]]
                    if end_id is not None:
                        own = np.append(own, np.array(end_id, "<u4"))
                    at, stop = 0, len(own) % capacity or min(len(own), capacity)
                    k = 0
                    while at < len(own):
                        part = own[at:stop]
                        rows.append(first + i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            lists.append(part.astype(np.int32))
                        at, stop, k = stop, stop + capacity, k + 1
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, T.StructType(fields))


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit over falling lengths, all pieces of a length at once: they go to the fullest
    sequences that still take one, as many to each as fit."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}  # room left: patterns
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_ if r >= size):
            each = room // size
            groups = open_.pop(room)
            while groups and left:
                pattern, times = groups.pop()
                full = min(times, left // each)
                if full:
                    open_.setdefault(room - each * size, []).append((pattern | {size: each}, full))
                    left -= full * each
                if full < times:
                    rest = times - full
                    if 0 < left < each:
                        open_.setdefault(room - left * size, []).append((pattern | {size: left}, 1))
                        rest, left = rest - 1, 0
                    if rest:
                        groups.append((pattern, rest))
                        if left == 0:
                            break
            if groups:
                open_.setdefault(room, []).extend(groups)
            if not left:
                break
        each = capacity // size
        if left >= each:
            open_.setdefault(capacity - each * size, []).append(({size: each}, left // each))
        if left % each:
            open_.setdefault(capacity - left % each * size, []).append(({size: left % each}, 1))
    return [g for groups in open_.values() for g in groups]


class _Sums:
    """Subset sums up to room of a histogram (sizes rising, counts): bit t of reach[k] tells
    whether t is a sum of pieces of the k smallest sizes."""

    def __init__(self, counts: dict[int, int], room: int):
        self.sizes = sorted(s for s, c in counts.items() if c and s <= room)
        self.counts = [min(counts[s], room // s) for s in self.sizes]
        full = (1 << room + 1) - 1
        bits, self.reach = 1, [1]
        for size, left in zip(self.sizes, self.counts):
            if bits == full:
                break  # and so are all that follow
            step = 1
            while left:
                step = min(step, left)
                bits |= bits << size * step & full
                left -= step
                step *= 2
            self.reach.append(bits)

    def holds(self, k: int, total: int) -> bool:
        return self.reach[min(k, len(self.reach) - 1)] >> total & 1 == 1

    def of(self, total: int, k: int | None = None) -> Iterator[tuple[int, ...]]:
        """The ways to reach a sum with pieces of the k smallest sizes, long pieces first."""
        k = len(self.sizes) if k is None else k
        if not total:
            yield ()
            return
        k = min(k, bisect.bisect_right(self.sizes, total))
        while k and self.holds(k, total):
            k -= 1
            size = self.sizes[k]
            for n in range(min(self.counts[k], total // size), 0, -1):
                rest = total - n * size
                if self.holds(k, rest):
                    for others in self.of(rest, k):
                        yield (size,) * n + others


def contained(small: tuple[int, ...], large: tuple[int, ...], steps: int = 2000) -> bool:
    """Whether the pieces of small fit together into those of large (both falling). An answer
    that takes more steps counts as no, which only keeps a filling."""
    seen: set[tuple[int, ...]] = set()
    stack = [(0, large)]
    while stack and steps:
        steps -= 1
        i, rooms = stack.pop()
        if i == len(small):
            return True
        if rooms in seen:
            continue
        seen.add(rooms)
        piece = small[i]
        for room in sorted({r for r in rooms if r >= piece}, reverse=True):
            after = list(rooms)
            after.remove(room)
            stack.append((i + 1, tuple(sorted([*after, room - piece], reverse=True))))
    return False


def undominated(counts: dict[int, int], room: int) -> Iterator[tuple[int, ...] | None]:
    """Undominated ways to fill the room with any number of pieces, one by one, least waste
    first, then long pieces first; None for each dominated one that is passed over.

    A filling is dominated if its pieces fit together into the pieces of another one. That
    one has a larger sum or longer pieces, so it comes earlier.
    """
    sums = _Sums(counts, room)
    found: list[tuple[int, ...]] = []
    for total in range(room, -1, -1):
        if sums.holds(len(sums.sizes), total):
            for filling in sums.of(total):
                if any(contained(filling, f) for f in found):
                    yield None
                    continue
                found.append(filling)
                yield filling
                if filling == (room,):
                    return  # it contains all others


def fillings(counts: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """All undominated ways to fill the room, least waste first."""
    return [f for f in undominated(counts, room) if f is not None]


def _branches(left: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int, int] | None]:
    """Pattern, how many sequences repeat it, and each one's waste: the ways to complete the
    longest piece, each as often as its pieces last; behind them the same ones fewer times.
    None for what is passed over."""
    longest = max(left)
    most: list[tuple[dict[int, int], int, int]] = []
    rest = left | {longest: left[longest] - 1}
    for filling in undominated(rest, capacity - longest):
        if filling is None:
            yield None
            continue
        pattern: dict[int, int] = {longest: 1}
        for s in filling:
            pattern[s] = pattern.get(s, 0) + 1
        # rest and left may change meanwhile, but are as they were when a branch is taken.
        most.append((pattern, min(left[s] // k for s, k in pattern.items()), capacity - longest - sum(filling)))
        yield most[-1]
    for pattern, times, lost in most:
        for fewer in range(times - 1, 0, -1):
            yield pattern, fewer, lost


def complete_bins(counts: dict[int, int], capacity: int, nodes: int | None = None) -> list[Pattern]:
    """A packing of the histogram in as few sequences as the search finds.

    Branch and bound by bin completion: the longest piece left is completed by each
    undominated filling in turn, least waste first; a branch ends when its waste exceeds what
    a better solution may waste. Best fit is the first solution. At the lower bound, or after
    `nodes` fillings (by default in proportion to the distinct lengths, so that whole branches
    end), the best solution so far is the answer; without that limit the search is complete.
    """
    return search(counts, capacity, nodes)[0]


def search(counts: dict[int, int], capacity: int, nodes: int | None = None) -> tuple[list[Pattern], int, int]:
    """The plan of complete_bins, the lower bound of its sequences, and the nodes visited."""
    left = {s: c for s, c in counts.items() if c}
    total = sum(s * c for s, c in left.items())
    bound = -(-total // capacity)
    best = best_fit(left, capacity)
    used = sum(t for _, t in best)
    limit = max(LEAST_NODES, NODES * len(left)) if nodes is None else nodes
    seen, bins, waste = 0, 0, 0
    done: list[tuple[dict[int, int], int, int]] = []
    stack = [_branches(left, capacity)] if left else []
    while stack and used > bound and seen < limit:
        step = next(stack[-1], ())
        if step is None:
            seen += 1
            continue
        spare = (used - 1) * capacity - total - waste
        # The first pass comes least waste first, the second repeats it with fewer sequences.
        if step:
            seen += 1
            pattern, times, lost = step
            if times * lost > spare:
                continue
            for s, k in pattern.items():
                left[s] -= times * k
                if not left[s]:
                    del left[s]
            done.append(step)
            bins, waste = bins + times, waste + times * lost
            if left:
                stack.append(_branches(left, capacity))
                continue
            used, best = bins, [(p, t) for p, t, _ in done]
        else:
            stack.pop()
        if done:
            pattern, times, lost = done.pop()
            for s, k in pattern.items():
                left[s] = left.get(s, 0) + times * k
            bins, waste = bins - times, waste - times * lost
    return best, bound, seen


def _places(plan: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Columns that turn a length and a rank within it into a sequence and an offset."""
    taken: dict[int, int] = {}
    rows, first = [], 0
    for pattern, times in sorted(plan, key=lambda p: sorted(p[0].items(), reverse=True), reverse=True):
        offset = 0
        for size in sorted(pattern, reverse=True):
            each = pattern[size]
            rows.append((size, taken.get(size, 0), each, first, offset))
            taken[size] = taken.get(size, 0) + each * times
            offset += size * each
        first += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns doc_id, piece, length from 1 to
    capacity), in as few sequences as the search finds.

    pieces is read three times, so it should be a written table. The driver sees the
    histogram of lengths alone, at most `capacity` rows.
    """
    spark = pieces.sparkSession
    ship(spark)
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if any(not 1 <= s <= capacity for s in counts):
        raise ValueError(f"a piece is empty or longer than {capacity}")
    size, begin, each, first, offset = _places(complete_bins(counts, capacity))
    shift = 1 << 44  # ranks stay below it, and lengths below 2**19
    key = size * shift + begin
    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], "__number", sum(counts.values()))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    given = list(pieces.columns)
    names = [*given, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("__number").to_numpy().astype(np.int64)
            at = np.searchsorted(key, length * shift + rank, side="right") - 1
            nth = rank - begin[at]
            columns = {n: batch.column(n) for n in given}
            columns["sequence_id"] = pa.array(first[at] + nth // each[at])
            columns["offset"] = pa.array(offset[at] + nth % each[at] * length)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every document.

    An empty table gives no rows. Null ids are allowed; pieces without an id are told apart
    by their place alone.
    """
    return pack(cut_lineage(token_pieces(docs, tokenizer, capacity, end_id)), capacity)
