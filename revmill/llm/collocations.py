"""Collocations: phrases that are more frequent than their parts suggest, by language.

Frequent phrases are mined by the partitioning of Savasere, Omiecinski and Navathe (SON). A
shard is the text that a task holds at a time. Each shard is mined completely, level by level,
at the support that is its language's share of the shard, in characters, times the global one:
a phrase that falls short of that in every shard falls short globally. The locally frequent
phrases of all shards are united. A phrase that some shards didn't report occurs there at most
one time less than their support; united phrases that can't reach the global support even so
are left out, which loses none. A second pass counts all remaining candidates in every shard;
what a shard has reported before it needn't send again. The sums are exact: words are told
apart by a hash of 64 bits, phrases by one of 96, and inside a shard by the numbers of their
parts. Phrases and counts travel as packed arrays by ranges of the hash.

This is done twice: for words and pairs, and then for longer phrases, which are looked at only
where all their pairs are frequent globally. With many more shards than the support, local
support is 1 and prunes nothing, so that what a pass sends grows like the distinct pairs of the
shards, then like the distinct longer phrases made of frequent pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revmill.llm import lookup, packed
from revmill.llm.common import bound_batches, if_small, ship, text_of
from revmill.llm.vectext import Chars, combine, mix64, runs, small_batches
from revmill.session import cut_lineage, scratch

# What ends a piece of text, and what ends a word inside it.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
# A document without a language.
UNKNOWN = "und"
# Characters of a shard, up to half as many more, and characters cut into words at a time: a
# worker's memory follows these.
SHARD_CHARS = 20_000_000
CHARS = 1 << 20
# Parts that a level's phrases are counted in, one after another.
PARTS = 8
# Characters of all texts for each range of hashes that one task adds up.
RANGE_CHARS = 32_000_000

_BLANKS = re.compile(f"[{BLANKS}]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


class Shard:
    """The words of a stretch of documents, as arrays, and their texts if phrases are read."""

    def __init__(self, with_text: bool = False) -> None:
        self.with_text = with_text
        self.langs: dict[str, int] = {}
        self.chars: list[int] = []
        self.totals: list[int] = []
        self.texts: list[str] = []
        self.firsts: list[int] = []
        self.words = 0
        self.pieces = 0
        self._parts: list[tuple[np.ndarray, ...]] = []

    def add(self, texts: list[str], langs: list[str], totals: list[int]) -> None:
        chars = Chars(texts, separator=10)
        chars.lower_ascii()
        ends = np.isin(chars.codes, np.array([ord(c) for c in PIECE_ENDS], np.uint32))
        begin, end = runs(~(ends | (chars.codes == 32) | (chars.codes == 9)))
        for lang, total, text in zip(langs, totals, texts):
            if lang not in self.langs:
                self.langs[lang] = len(self.langs)
                self.chars.append(0)
                self.totals.append(total)
            self.chars[self.langs[lang]] += len(text)
        lang = np.fromiter((self.langs[x] for x in langs), np.int32, len(langs))[chars.owners(begin)]
        keys = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in self.langs], np.uint64)
        hashes = combine(keys[lang], chars.hashes(begin, end))
        piece = np.cumsum(ends, dtype=np.int32)
        places = (begin.astype(np.int32), end.astype(np.int32)) if self.with_text else ()
        self._parts.append((hashes, lang, piece[begin] + np.int32(self.pieces), *places))
        if self.with_text:
            self.texts.append(chars.text)
            self.firsts.append(self.words)
        self.words += len(begin)
        self.pieces += int(piece[-1]) if len(piece) else 0

    def close(self) -> None:
        columns = list(zip(*self._parts))
        self._parts = []
        self.hash, self.lang, self.piece = (np.concatenate(columns[i]) for i in range(3))
        self.begin, self.end = (np.concatenate(c) for c in columns[3:]) if self.with_text else (None, None)

    def supports(self, min_count: int) -> np.ndarray:
        """The local support of each language."""
        return np.array([local_support(min_count, c, t) for c, t in zip(self.chars, self.totals)], np.int64)

    def tag(self) -> int:
        """A number that the shard's words give it; the same whenever they are read."""
        return int(mix64(self.hash + np.arange(self.words, dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))

    def phrase(self, at: np.ndarray, size: int) -> list[str]:
        """The phrases of so many words that begin at these words, with single blanks."""
        owner = np.searchsorted(self.firsts, at, side="right") - 1
        out = []
        for o, a, b in zip(owner.tolist(), self.begin[at].tolist(), self.end[at + size - 1].tolist()):
            text = self.texts[o][a:b]
            text = text.lower() if text.isascii() else text.translate(_LOWER)
            out.append(_BLANKS.sub(" ", text) if size > 1 and ("  " in text or "\t" in text) else text)
        return out

    def levels(self, most: int, keep) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each level, in words: the kept phrases' hashes, counts, and a word each begins
        at, in several parts. keep(size, hashes, counts, languages) tells which of a level's
        distinct phrases stay; one is looked at only if both of its shorter parts stayed."""
        number = np.zeros(0, np.int32)
        for size in range(1, most + 1):
            if size == 1:
                at = np.arange(self.words, dtype=np.int32)
                part = (self.hash >> np.uint64(40)) % np.uint64(PARTS)
            else:
                whole = (number[:-1] >= 0) & (number[1:] >= 0) & (self.piece[:-1] == self.piece[1:])
                at = np.flatnonzero(whole).astype(np.int32)
                part = (number[at] + number[at + 1]) % PARTS
            if not len(at):
                return
            part = part.astype(np.uint8)
            following, total = np.full(self.words, -1, np.int32), 0
            for p in range(PARTS):
                own = at[part == p]
                # A phrase is told apart by the numbers of its two shorter parts.
                keys = self.hash[own] if size == 1 else number[own] * np.int64(self.words) + number[own + 1]
                _, first, back, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                example = own[first]
                hashes = self.hash[example] if size == 1 else combine(*[self.hash[example + k] for k in range(size)])
                kept = keep(size, hashes, count, self.lang[example])
                following[own] = np.where(kept, total + np.cumsum(kept) - 1, -1).astype(np.int32)[back]
                total += int(kept.sum())
                yield size, hashes[kept], count[kept], example[kept]
            number = following


def shards(batches: Iterator[pa.RecordBatch], size: int, with_text: bool = False) -> Iterator[Shard]:
    """Shards of rows (lang, text, total characters of the language), of about so many
    characters; what is left behind the last one joins it, unless it is half a shard or more. A
    small shard would have a support that prunes nothing."""
    shard, filled = Shard(with_text), 0
    waiting, held = [], 0
    for batch in batches:
        langs, texts, totals = (batch.column(i).to_pylist() for i in range(3))
        for a, b in small_batches(texts, CHARS):
            part = texts[a:b], langs[a:b], totals[a:b]
            chars = sum(map(len, part[0]))
            if filled < size:
                shard.add(*part)
                filled += chars
                continue
            waiting.append(part)
            held += chars
            if held >= size / 2:
                shard.close()
                yield shard
                shard, filled = Shard(with_text), held
                for part in waiting:
                    shard.add(*part)
                waiting, held = [], 0
    for part in waiting:
        shard.add(*part)
    if shard.langs:
        shard.close()
        yield shard


def local_support(min_count: int, chars: int, total: int) -> int:
    """The least count in a shard that some shard must have for min_count in all."""
    return max(1, -(-min_count * chars // max(total, 1)))


def _key(shard: Shard, at: np.ndarray, size: int) -> np.ndarray:
    """A second hash of the phrases that begin at these words, so that two tell them apart."""
    second = combine(*[shard.hash[at + k] for k in reversed(range(size))], np.full(len(at), size, np.uint64))
    return (second >> np.uint64(32)).astype(np.uint32)


class _Parcels:
    """Phrases of a shard by language and range of the hash, packed."""

    def __init__(self, ranges: int):
        self.ranges = ranges
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, lang: np.ndarray, hashes: np.ndarray, key: np.ndarray, count: np.ndarray) -> None:
        self.parts.append((lang, hashes.view(np.int64), key, count.astype(np.uint32)))

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        """language, range, packed."""
        if not any(len(part[0]) for part in self.parts):
            return
        lang, hashes, key, count = (np.concatenate(c) for c in zip(*self.parts))
        upper = ((hashes >> np.int64(32)) + np.int64(1 << 31)) * np.int64(self.ranges) >> np.int64(32)
        group = lang.astype(np.int64) * self.ranges + upper
        order = np.lexsort((hashes, group))
        group = group[order]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        for g, rows in zip(group[first].tolist(), np.split(order, first[1:])):
            yield g // self.ranges, g % self.ranges, packed.pack(hashes[rows], key[rows], count[rows])


def _joined(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Distinct hashes and keys of packed rows, where each begins among all entries sorted by
    them, the entries' counts, and the row each comes from."""
    parts = [packed.unpack(x.as_py()) for x in table.column("packed")]
    row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    hashes, key, count = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((key, hashes))
    hashes, key = hashes[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (key[1:] != key[:-1]))))
    return hashes[first], key[first].astype(np.int64), first, count[order].astype(np.int64), row[order]


_LOCAL = "lang string, range int, packed binary, least long, owner long, words long"


def _miner(stored, low: int, high: int, min_count: int, shard_chars: int, ranges: int):
    """The locally frequent phrases of low to high words of each shard, and one row for each
    language with its words there. Shorter phrases are known already."""
    names = [c.split()[0] for c in _LOCAL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, shard_chars):
            least = shard.supports(min_count)
            parcels = _Parcels(ranges)

            def keep(size, hashes, count, lang):
                return count >= least[lang] if size >= low else lookup.holds(stored.value, hashes.view(np.int64))

            for size, hashes, count, at in shard.levels(high, keep):
                if size >= low:
                    parcels.add(shard.lang[at], hashes, _key(shard, at, size), count)
            langs, own = list(shard.langs), shard.tag()
            words = np.bincount(shard.lang, minlength=len(least)).tolist()
            rows = [(langs[g], None, None, int(least[g]), own, words[g]) for g in range(len(langs))]
            rows += [(langs[g], r, data, int(least[g]), own, None) for g, r, data in parcels.rows()]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], _LOCAL_TYPES)

    return run


_LOCAL_TYPES = pa.schema(
    {"lang": pa.string(), "range": pa.int32(), "packed": pa.binary(), "least": pa.int64(), "owner": pa.int64(), "words": pa.int64()}
)
_ABLE = "hash long, key long, known long, owner long, lang string"


def _unite(min_count: int):
    """Of a language and range: the phrases that can be frequent, what was reported of each,
    and a shard that reported it."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lang, missed = table.column("lang")[0].as_py(), table.column("missed")[0].as_py()
        hashes, second, first, count, row = _joined(table)
        least = table.column("least").to_numpy()[row]
        known = np.add.reduceat(count, first)
        excess = np.add.reduceat(count - (least - 1), first)
        able = excess + missed >= min_count
        owner = table.column("owner").to_numpy()[row[first]]
        columns = [hashes[able], second[able], known[able], owner[able]]
        return pa.Table.from_arrays(
            [*map(pa.array, columns), pa.array([lang] * int(able.sum()), pa.string())], ["hash", "key", "known", "owner", "lang"]
        )

    return run


_REST = "range int, packed binary, hash long, key long, size int, phrase string"


def _counter(stored, low: int, high: int, min_count: int, shard_chars: int, ranges: int):
    """What the miner left out of the stored phrases of low to high words: occurrences in the
    shards that didn't report a phrase, and its text from the shard that is to tell it."""
    names = [c.split()[0] for c in _REST.split(", ")]
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def rows(n: int, **columns) -> pa.RecordBatch:
        filled = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(filled, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = np.zeros(0, np.int64)

        def keep(size, hashes, count, lang):
            nonlocal owner
            known, owners = lookup.beside(stored.value, hashes.view(np.int64))
            owner = owners[0][known] if owners else owner
            return known

        for shard in shards(batches, shard_chars, with_text=True):
            least, own = shard.supports(min_count), shard.tag()
            parcels = _Parcels(ranges)
            for size, hashes, count, at in shard.levels(high, keep):
                if size < low or not len(at):
                    continue
                key = _key(shard, at, size)
                rest = np.flatnonzero(count < least[shard.lang[at]])
                parcels.add(np.zeros(len(rest), np.int32), hashes[rest], key[rest], count[rest])
                tells = np.flatnonzero(owner == own)
                texts = shard.phrase(at[tells], size)
                yield rows(len(tells), hash=hashes[tells].view(np.int64), key=key[tells].astype(np.int64), size=np.full(len(tells), size), phrase=texts)
            found = list(parcels.rows())
            yield rows(len(found), range=[r for _, r, _ in found], packed=[data for *_, data in found])

    return run


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    hashes, second, first, count, _ = _joined(table)
    return pa.table({"hash": hashes, "key": second, "rest": np.add.reduceat(count, first)})


def _sent(rows: DataFrame, *with_it: str):
    """The hashes of rows as files by ranges, mapped by the workers rather than sent; what is
    sent is the files' addresses."""
    spark = rows.sparkSession
    dealt = lookup.dealt(rows, lookup.shard_count(rows.count(), lookup.ROWS_PER_FILE), "hash")
    ordered = dealt.sortWithinPartitions("shard", "hash")
    files = ordered.mapInArrow(lookup.hash_files(scratch(spark, "phrases"), "hash", *with_it), lookup.FILES)
    return spark.sparkContext.broadcast(lookup.written(files))


def frequent_phrases(docs: DataFrame, min_count: int, max_words: int, shard_chars: int = SHARD_CHARS) -> tuple[DataFrame, DataFrame]:
    """lang, size, phrase, hash, a of every phrase of 1 to max_words words with a >= min_count
    occurrences in its language, and lang, n: all word occurrences. Both are written tables.

    docs is read several times and must give the same rows each time. Should its partitions
    differ between two reads, counts would still be those of the rows as they were read, but a
    phrase's text may be missing, which raises.
    """
    spark = docs.sparkSession
    ship(spark)
    bound_batches(spark)
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), text_of().alias("text"))
    sizes = cut_lineage(texts.groupBy("lang").agg(F.sum(F.char_length("text").cast("long")).alias("total")))
    n_langs = sizes.count()
    texts = texts.join(if_small(sizes, n_langs, 64), "lang").select("lang", "text", "total")
    total = sizes.agg(F.sum("total")).first()[0] or 0
    # A range's entries are at most its part of all words, so its rows fit a task.
    ranges = max(1, -(-total // RANGE_CHARS))
    langs, known, frequent = None, None, None
    for low, high in ((1, min(2, max_words)), (3, max_words)):
        # Longer phrases need frequent ones that are one word shorter.
        if low > high or frequent is not None and frequent.filter(F.col("size") == low - 1).isEmpty():
            break
        steps = (low, high, min_count, shard_chars, ranges)
        local = cut_lineage(texts.mapInArrow(_miner(known, *steps), _LOCAL))
        shares = local.filter("packed IS NULL").groupBy("lang").agg(F.sum("words").alias("n"), F.sum(F.col("least") - 1).alias("missed"))
        shares = cut_lineage(shares)
        reported = local.filter("packed IS NOT NULL").join(if_small(shares.select("lang", "missed"), n_langs, 64), "lang")
        able = cut_lineage(reported.groupBy("lang", "range").applyInArrow(_unite(min_count), _ABLE))
        wanted = able.select("hash", "owner")
        if frequent is not None:
            wanted = wanted.unionAll(frequent.select("hash", F.lit(0).cast("long").alias("owner")))
        counted = cut_lineage(texts.mapInArrow(_counter(_sent(cut_lineage(wanted), "owner"), *steps), _REST))
        rest = counted.filter("packed IS NOT NULL").groupBy("range").applyInArrow(_add_up, "hash long, key long, rest long")
        named = counted.filter("phrase IS NOT NULL").groupBy("hash", "key").agg(F.max("size").alias("size"), F.max("phrase").alias("phrase"))
        sums = able.join(rest, ["hash", "key"], "left").withColumn("a", F.col("known") + F.coalesce("rest", F.lit(0)))
        often = sums.filter(F.col("a") >= min_count).join(named, ["hash", "key"], "left")
        # A phrase without text would come from a table that changed between two reads.
        text = F.coalesce("phrase", F.raise_error(F.lit("the documents changed while they were read")).cast("string"))
        found = cut_lineage(often.select("lang", "size", text.alias("phrase"), "hash", "a"))
        langs = shares if langs is None else langs
        frequent = found if frequent is None else frequent.unionAll(found)
        known = _sent(found.select("hash")) if high < max_words else None
    return frequent, langs.filter("n > 0").select("lang", "n")


def weakest_cuts(frequent: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, size, phrase, a, n, l, r, score of the phrases of two words or more: the cut into
    two parts with the lowest floor(1000 a n / (l r)), the first such cut of several."""
    words = frequent.filter("size >= 2").join(langs, "lang")
    cuts = words.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("tail", F.expr("substring_index(phrase, ' ', k - size)"))
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # Products of counts in 38 digits: 1000 a n of some 10^17 words and 10^17 occurrences.
    wide = {c: F.col(c).cast("decimal(17,0)") for c in ("a", "n", "l", "r")}
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"])
    cuts = cuts.withColumn("under", wide["l"] * wide["r"])
    cuts = cuts.withColumn("score", F.expr("over div under"))
    weakest = cuts.groupBy("lang", "size", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "size", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")


def covered(frequent: DataFrame, percent: int) -> DataFrame:
    """lang, phrase of those that lie inside a longer phrase with at least so many percent of
    their own occurrences."""
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1),"
        " at -> array_join(slice(split(phrase, ' '), at, n), ' '))))"
    )
    inside = frequent.filter("size >= 3").select("lang", F.explode(inner).alias("phrase"), "a")
    longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    short = frequent.filter("size >= 2").select("lang", "phrase", "a").join(longest, ["lang", "phrase"])
    return short.filter(F.col("longer") * 100 >= F.col("a") * percent).select("lang", "phrase")


def collocations(
    docs: DataFrame, min_count: int = 100, max_words: int = 5, cover_percent: int = 100, top: int = 2000, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first `top` phrases of 2 to
    max_words words by score, then occurrences (both descending), then phrase.

    A-Z count as a-z. Phrases lie between two piece ends; all their occurrences count,
    overlapping ones too. The score is that of the weakest cut (`weakest_cuts`). Phrases that
    hardly occur outside a longer one (`covered`) are left out.

    Null texts are empty; a null language is "und", together with rows that say so. Repeated
    rows count as often as they occur. Empty texts and tables have no phrases. Other columns
    are left out.
    """
    frequent, langs = frequent_phrases(docs, min_count, max_words, shard_chars)
    scored = weakest_cuts(frequent, langs).join(covered(frequent, cover_percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is ranked by parts first, as many that neither a part nor the parts' first
    # rows together grow faster than the root of all phrases.
    parts = 1 + int((frequent.count() / max(top, 1)) ** 0.5)
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = scored.withColumn("part", part)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
