"""Removes blocks of lines that an earlier document holds already, by pairwise alignment.

A line ends at a line feed, or behind a sentence's end, so that a passage set in the middle of
a paragraph has lines of its own. Lines are compared by the 64-bit hash of what is left
without outer white space. A window is a line of some words, or as many consecutive lines as
reach them, counted from each line onward and from each line back. A window that several
documents share pairs each later one with the first one that holds it: a window in n documents
gives n - 1 pairs, however common it is, and every line of a common block lies in a window
inside the block. Windows of a whole block's words pair a document with the first holder of the
block itself as well, not just with the first holders of its parts. Each pair is aligned by
patience diff, and the later document loses its aligned blocks, with those that it holds more
often than the earlier one.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm import vectext
from revmill.llm.common import if_small, ship, text_of
from revmill.session import cut_lineage

# A line of fewer words finds pairs only together with the lines beside it: alone, such lines
# are shared by chance. It is still aligned.
PAIR_WORDS = 4
# A run of aligned lines with fewer words stays.
BLOCK_WORDS = 25
# A line counts as one word for so many characters at least, whether it has blanks or not.
WORD_CHARS = 24

# Scripts written without blanks between words (Thai to Myanmar, Khmer, kana and
# Han), and what the language counts as white space beyond ASCII.
DENSE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
WIDE_SPACES = [c for c in range(128, 0x3001) if chr(c).isspace()]


def _before(marks: np.ndarray) -> np.ndarray:
    """How many marks there are before each position, and before the end."""
    out = np.zeros(len(marks) + 1, np.int32)
    np.cumsum(marks, out=out[1:])
    return out


def _starts(inside: np.ndarray) -> np.ndarray:
    out = inside.copy()
    out[1:] &= ~inside[:-1]
    return out


def cut_lines(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The lines that aren't blank, of all texts end to end: 64-bit hash and words of each, its
    begin and end in its text, and where each text's lines begin. A line ends where the next
    one begins; outer white space is no part of the hash.

    Words stand between white space, each character of a script without blanks is one, and
    WORD_CHARS characters hold one at least.
    """
    chars = vectext.Chars(texts, separator=10)
    codes = chars.codes
    space = vectext.ascii_space(codes) | ((codes >= 28) & (codes <= 31))
    wide = np.flatnonzero(codes > 127)
    space[wide] = np.isin(codes[wide], WIDE_SPACES)
    feed = codes == 10
    # An edge behind each line feed, and behind the blanks that follow a sentence's end.
    begin, end = vectext.runs(space & ~feed)
    last = codes[np.maximum(begin - 1, 0)]
    closed = (begin > 0) & ((last == ord(".")) | (last == ord("!")) | (last == ord("?")))
    edge = np.zeros(len(codes) + 1, bool)
    edge[0] = True
    edge[np.flatnonzero(feed) + 1] = True
    edge[end[closed]] = True
    edge = np.flatnonzero(edge)
    solid = np.flatnonzero(~space)
    at = np.searchsorted(solid, edge)
    full = np.flatnonzero(at[1:] > at[:-1])
    begin, end = edge[full], edge[full + 1]
    head, tail = solid[at[full]], solid[at[full + 1] - 1] + 1
    count = lambda marks: (lambda n: n[tail] - n[head])(_before(marks))
    words = np.maximum(count(_starts(~space)), -(-(tail - head) // WORD_CHARS))
    dense = np.zeros(len(codes), bool)
    for a, b in DENSE:
        dense[wide] |= (codes[wide] >= a) & (codes[wide] <= b)
    if dense.any():
        words = np.maximum(words, count(dense) + count(_starts(~space & ~dense)))
    owner = chars.owners(begin)
    first = chars.starts[owner]
    # The separator that stands behind each text is no part of its last line.
    end = np.minimum(end, chars.starts[owner + 1] - 1)
    edges = np.searchsorted(begin, chars.starts)
    return chars.hashes(head, tail), words, begin - first, end - first, edges


def windows(words: np.ndarray, edges: np.ndarray, least: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the shortest window of `least` words or more from each line onward, or
    with back up to each line; none crosses the edges between documents."""
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    at = np.arange(len(words))
    doc = np.searchsorted(edges, at, side="right") - 1
    if back:
        begin, end = np.searchsorted(total, total[1:] - least, side="right") - 1, at + 1
        whole = begin >= edges[doc]
    else:
        begin, end = at, np.searchsorted(total, total[:-1] + least)
        whole = end <= edges[doc + 1]
    return begin[whole], end[whole]


def _keys(hashes: np.ndarray, words: np.ndarray, edges: np.ndarray, steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the windows of each document, end to end, and where each one's begin."""
    ways = [windows(words, edges, least, back) for least in steps for back in (False, True)]
    begin, end = (np.concatenate(x) for x in zip(*ways))
    h = vectext.stretches(hashes, begin, end)
    doc = np.searchsorted(edges, begin, side="right") - 1
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h.view(np.int64), np.searchsorted(doc, np.arange(len(edges)))


def _lines(steps: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in vectext.small_batches(texts):
                hashes, words, begins, ends, edges = cut_lines(texts[a:b])
                keys, firsts = _keys(hashes, words, edges, steps)
                columns = [pa.array(x, kind) for x, kind in ((hashes.view(np.int64), pa.int64()), (words, pa.int32()), (begins, pa.int32()), (ends, pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        *[pa.ListArray.from_arrays(pa.array(edges, pa.int32()), x) for x in columns],
                        pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(keys)),
                    ],
                    ["key", "hashes", "words", "begins", "ends", "keys"],
                )

    return run


def _rising(values: list[int]) -> list[int]:
    """Positions of a longest rising subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        before.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def longest_run(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Begin in a, begin in b and length of the longest run of lines that both hold, the first
    one in b of several: by a suffix automaton of a, in proportion to both lengths."""
    after: list[dict[int, int]] = [{}]
    link, size, end, last = [-1], [0], [0], 0
    for p, x in enumerate(a):
        new = len(after)
        after.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(p + 1)
        at, last = last, new
        while at >= 0 and x not in after[at]:
            after[at][x] = new
            at = link[at]
        if at < 0:
            continue
        to = after[at][x]
        if size[to] != size[at] + 1:
            copy = len(after)
            after.append(dict(after[to]))
            link.append(link[to])
            size.append(size[at] + 1)
            end.append(end[to])
            link[to] = copy
            while at >= 0 and after[at].get(x) == to:
                after[at][x] = copy
                at = link[at]
            to = copy
        link[new] = to
    best, at, n = (0, 0, 0), 0, 0
    for p, x in enumerate(b):
        while at and x not in after[at]:
            at = link[at]
            n = size[at]
        if x in after[at]:
            at, n = after[at][x], n + 1
        if n > best[2]:
            best = (end[at] - n, p + 1 - n, n)
    return best


def repeated(a: list[int], b: list[int], words_a: list[int], words_b: list[int], least: int) -> set[int]:
    """Positions of b in runs of `least` words or more that a holds, however often b has them."""
    found: set[int] = set()
    for back in (False, True):
        held = {tuple(a[x:y]) for x, y in _spans_of(words_a, least, back)}
        for x, y in _spans_of(words_b, least, back):
            if tuple(b[x:y]) in held:
                found.update(range(x, y))
    return found


def _spans_of(words: list[int], least: int, back: bool) -> Iterator[tuple[int, int]]:
    begin, end = windows(np.array(words, np.int32), np.array([0, len(words)]), least, back)
    return zip(begin.tolist(), end.tolist())


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions of equal lines, rising in both: equal heads and tails, then lines
    that occur once on both sides as anchors, then the stretches between anchors. Where nothing
    is an anchor, the longest common run is one."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {x: i + p for p, x in enumerate(a[i:j]) if in_a[x] == 1 and in_b.get(x) == 1}
        once = [(place[x], k + p) for p, x in enumerate(b[k:m]) if x in place]
        anchors = [once[p] for p in _rising([x for x, _ in once])]
        if not anchors:
            if in_a.keys().isdisjoint(in_b):
                continue
            x, y, n = longest_run(a[i:j], b[k:m])
            anchors = [(i + x + p, k + y + p) for p in range(n)]
        for x, y in [*anchors, (j, m)]:
            stack.append((i, x, k, y))
            i, k = x + 1, y + 1
        out.extend(anchors)
    return out


def aligned(a: list[int], b: list[int]) -> list[int]:
    """Positions of b that align with a. Blocks that stand in another order are found by
    aligning again what is left, until nothing more aligns."""
    both = set(a) & set(b)
    left_a = [x for x in a if x in both]
    left_b = [(p, x) for p, x in enumerate(b) if x in both]
    found: list[int] = []
    while left_a and left_b:
        pairs = patience(left_a, [x for _, x in left_b])
        if not pairs:
            break
        gone_a, gone_b = {x for x, _ in pairs}, {y for _, y in pairs}
        found += [left_b[y][0] for y in gone_b]
        left_a = [x for p, x in enumerate(left_a) if p not in gone_a]
        left_b = [x for p, x in enumerate(left_b) if p not in gone_b]
    return sorted(found)


def _align(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("first_hashes", "later_hashes", "first_words", "later_words")]
            columns = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in columns]
            rows, places = [], []
            for r in range(batch.num_rows):
                a, b, *words = (values[at[r] : at[r + 1]] for at, values in columns)
                if np.array_equal(a, b):
                    hit = range(len(b))
                else:
                    a, b = a.tolist(), b.tolist()
                    hit = aligned(a, b)
                    both = set(a)
                    if len(hit) < sum(x in both for x in b):
                        # Copies beyond the number that the first holder has.
                        hit += set(repeated(a, b, *(w.tolist() for w in words), block_words)) - set(hit)
                rows += [r] * len(hit)
                places += hit
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(rows, pa.int64())), pa.array(places, pa.int32())], ["key", "line"]
            )

    return run


def _spans(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, lines, words_out = [], [], [], []
            columns = [batch.column(n) for n in ("found", "words", "begins", "ends")]
            for r in range(batch.num_rows):
                found, words, begins, ends = (c[r].values.to_numpy() for c in columns)
                found = np.unique(found)
                cuts = np.flatnonzero(np.diff(found) > 1) + 1
                spans, n, total = [], 0, 0
                for run_ in np.split(found, cuts):
                    size = int(words[run_].sum())
                    if size >= block_words:
                        spans.append({"begin": int(begins[run_[0]]), "end": int(ends[run_[-1]])})
                        n, total = n + len(run_), total + size
                if spans:
                    rows.append(r)
                    out.append(spans)
                    lines.append(n)
                    words_out.append(total)
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(rows, pa.int64())),
                    pa.array(out, kind),
                    pa.array(lines, pa.int32()),
                    pa.array(words_out, pa.int32()),
                ],
                ["key", "removed", "removed_lines", "removed_words"],
            )

    return run


def common_blocks(docs: DataFrame, pair_words: int = PAIR_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """key, removed (character ranges), removed_lines, removed_words of the documents that
    repeat blocks of earlier ones. key is (doc_id, hash of the text), the order of documents:
    rows that repeat an id and its text are one document and aren't compared."""
    ship(docs.sparkSession)
    key_type = docs.select(_key()).schema["key"].dataType
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("hashes", longs),
            *[T.StructField(n, ints) for n in ("words", "begins", "ends")],
            T.StructField("keys", longs),
        ]
    )
    lines = cut_lineage(docs.select(_key(), text_of().alias("text")).mapInArrow(_lines([pair_words, max(pair_words, block_words)]), schema))
    single = lines.dropDuplicates(["key"]) if _has_repeats(lines) else lines
    # A document has each of its windows once, so a count tells whether others share it.
    held = single.select("key", F.explode("keys").alias("h"))
    shared = cut_lineage(held.groupBy("h").count().filter("count > 1").select("h"))
    held = cut_lineage(held.join(if_small(shared, shared.count(), 32), "h"))
    firsts = cut_lineage(held.groupBy("h").agg(F.min("key").alias("first")))
    pairs = cut_lineage(held.join(firsts, "h").filter("first < key").select("first", "key").distinct())
    later = single.select(F.col("key").alias("k"), F.col("hashes").alias("later_hashes"), F.col("words").alias("later_words"))
    both = pairs.join(later, F.col("key") == F.col("k")).drop("k")
    earlier = single.select(F.col("key").alias("k"), F.col("hashes").alias("first_hashes"), F.col("words").alias("first_words"))
    both = both.join(earlier, F.col("first") == F.col("k"))
    hits = both.select("key", "first_hashes", "later_hashes", "first_words", "later_words").mapInArrow(
        _align(block_words), T.StructType([T.StructField("key", key_type), T.StructField("line", T.IntegerType())])
    )
    # Both arrays of a document have at most one entry for each of its own lines.
    found = hits.groupBy("key").agg(F.collect_set("line").alias("found"))
    whole = found.join(single.select("key", "words", "begins", "ends"), "key")
    out = T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("removed", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
            T.StructField("removed_lines", T.IntegerType()),
            T.StructField("removed_words", T.IntegerType()),
        ]
    )
    return cut_lineage(whole.mapInArrow(_spans(block_words), out))


def _key():
    return F.struct(F.col("doc_id"), F.xxhash64(text_of()).alias("text_hash")).alias("key")


def _has_repeats(lines: DataFrame) -> bool:
    row = lines.agg(F.count("*"), F.countDistinct("key")).first()
    return row[0] != row[1]


def drop_common_blocks(
    docs: DataFrame, pair_words: int = PAIR_WORDS, block_words: int = BLOCK_WORDS, prefix: str = ""
) -> DataFrame:
    """docs with common blocks cut from the text, and removed (character ranges of the old
    text, null where nothing was cut), removed_lines, removed_words; prefix goes before these
    names.

    Every row stays, also one whose whole text is cut: its text is then empty. A null text
    stays null; a null id sorts first. Columns named like the new ones are replaced.
    """
    blocks = common_blocks(docs, pair_words, block_words)
    new = tuple(prefix + n for n in ("removed", "removed_lines", "removed_words"))
    small = if_small(blocks, blocks.count(), 400)
    small = small.select(F.col("key").alias("__cut_key"), *[F.col(n.removeprefix(prefix)).alias(n) for n in new])
    base = docs.drop(*new).withColumn("__key", _key())
    joined = base.join(small, F.col("__key") == F.col("__cut_key"), "left")
    removed = F.col(new[0])
    begins = F.concat(F.array(F.lit(0)), removed["end"])
    ends = F.concat(removed["begin"], F.array(F.char_length("text")))
    kept = F.zip_with(begins, ends, lambda a, b: F.substr(F.col("text"), a + 1, b - a))
    text = F.when(removed.isNull(), F.col("text")).otherwise(F.concat_ws("", kept))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in new]
    zero = F.lit(0)
    return joined.select(
        *columns, removed, *[F.coalesce(n, zero).alias(n) for n in new[1:]]
    )
