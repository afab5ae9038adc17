"""Byte-level BPE over whole batches: each distinct piece of a batch is encoded once.

The piece pattern of a byte-level tokenizer (contractions, an optional space before a run of
letters, digits or other signs, white space) depends on character classes only, so the pieces
of a batch are found from class changes in one array. Distinct pieces are encoded by the
library's own merge ranks and put back by position. Files of another kind, and texts that
hold an added special string, go through the tokenizers library itself, text by text.
"""

from __future__ import annotations

import json

import numpy as np

from revmill.llm.vectext import Chars, runs, small_batches

# The published piece pattern of byte-level BPE, and its contractions.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
# Distinct pieces remembered by a worker; a full memory is dropped, which costs time only.
REMEMBERED = 1_000_000

_tables: dict[str, np.ndarray] = {}
_encoders: dict[str, "Encoder"] = {}


def _classes() -> np.ndarray:
    """The class of every code point, from the regular expression engine's own tables."""
    if "class" not in _tables:
        import regex

        every = "".join(map(chr, range(0xD800))) + "" + "".join(map(chr, range(0xE001, 0x110000)))
        table = np.full(0x110000, OTHER, np.uint8)
        for value, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                begin = ord(every[m.start()])
                table[begin : ord(every[m.end() - 1]) + 1] = value
        _tables["class"] = table
    return _tables["class"]


def pieces(chars: Chars) -> np.ndarray:
    """Begins of the pattern's pieces, in order, over all texts of the batch."""
    codes, n = chars.codes, len(chars.codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[codes]
    first = np.zeros(n + 1, bool)
    first[chars.starts] = True
    last = first[1:]  # last[i]: a text ends behind position i
    start = first[:n] | np.concatenate(([True], kind[1:] != kind[:-1]))
    ends_run = np.concatenate((start[1:], [True]))
    # The last white-space character before something else leaves its run; a blank joins
    # what follows, any other one stands alone.
    leaves = (kind == SPACE) & ends_run & ~last
    start |= leaves
    at = np.flatnonzero(leaves)
    start[at + 1] = codes[at] != 32
    # Contractions, where a piece begins at an apostrophe.
    quotes = np.flatnonzero((codes == 39) & start[:n] & ends_run)
    quotes = quotes[~last[quotes]]
    if len(quotes):
        padded = np.concatenate((codes, [0, 0, 0]))
        taken = np.zeros(len(quotes), np.int64)
        for c in CONTRACTIONS:
            same = taken == 0
            for k, ch in enumerate(c):
                inside = quotes + 1 + k
                same &= (padded[inside] == ord(ch)) & ((k == 0) | ~first[np.minimum(inside, n)])
            taken[same] = len(c)
        # A contraction's end can put a later apostrophe at a piece's begin or not; its
        # own letters hold none, so the marks do not disturb each other.
        begin, size = quotes[taken > 0], taken[taken > 0]
        start[begin + 1] = False
        two = begin[size == 2] + 2
        start[two] = False
        behind = begin + 1 + size
        start[behind[behind < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Token ids of texts, as the library gives them without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.ranks = self._ranks(spec)
        if self.ranks is not None:
            import tiktoken

            self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self._forget()

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        """Ranks by bytes, if the file is plain byte-level BPE with the known pattern."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
            and not spec.get("truncation")
            and not spec.get("padding")
            and not model.get("dropout")
            and not model.get("continuing_subword_prefix")
            and not model.get("end_of_word_suffix")
            and not model.get("ignore_merges")
        )
        if not plain:
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"] for t in spec.get("added_tokens") or []}
        try:
            ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        except KeyError:
            return None
        # Merging by rank equals merging by the list only if ids follow the list's order.
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ids = [model["vocab"][t] for t in joined]
        return ranks if ids == sorted(ids) and len(set(ids)) == len(ids) else None

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str], blank: np.ndarray) -> None:
        """Adds pieces. Those that aren't white space are encoded in one call, a line each:
        a line feed is a piece of its own there, and its id occurs in no other piece."""
        lone = np.flatnonzero(blank)
        rest = np.flatnonzero(~blank)
        feed = self.core.encode_ordinary("\n")[0]
        flat = np.array(self.core.encode_ordinary("".join(texts[i] + "\n" for i in rest)), np.uint32)
        feeds = np.flatnonzero(flat == feed)
        size = np.zeros(len(texts), np.int64)
        size[rest] = np.diff(feeds, prepend=-1) - 1
        ids = [self.core.encode_ordinary(texts[i]) for i in lone]
        size[lone] = [len(i) for i in ids]
        tail = np.array([x for i in ids for x in i], np.uint32)
        order = np.concatenate([rest, lone])
        where = np.empty(len(texts), np.int64)
        where[order] = len(self.pool) + np.cumsum(size[order]) - size[order]
        self.pool = np.concatenate([self.pool, flat[flat != feed], tail])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.where = np.concatenate([self.where, where])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _batch(self, texts: list[str], want_ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Token counts, and all ids end to end."""
        chars = Chars(texts)
        begin = pieces(chars)
        if not len(begin):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint32)
        end = np.concatenate((begin[1:], [len(chars.codes)]))
        distinct, example, back = np.unique(chars.hashes(begin, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.flatnonzero((at == len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != distinct)) if len(self.known) else np.arange(len(distinct))
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = np.arange(len(distinct))
        if len(new):
            where = example[new]
            cut = [chars.text[i:j] for i, j in zip(begin[where].tolist(), end[where].tolist())]
            self._learn(distinct[new], cut, _classes()[chars.codes[end[where] - 1]] == SPACE)
            at = np.searchsorted(self.known, distinct)
        size = self.size[at][back]
        before = np.concatenate(([0], np.cumsum(size)))
        edge = np.searchsorted(begin, chars.starts)
        counts = before[edge[1:]] - before[edge[:-1]]
        if not want_ids:
            return counts, None
        place = np.repeat(self.where[at][back] - before[:-1], size) + np.arange(before[-1])
        return counts, self.pool[place]

    def _plain(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str], want_ids: bool = True):
        """Yields (first text, counts, ids) for consecutive runs of texts."""
        for a, b in small_batches(texts):
            part = texts[a:b]
            if self.ranks is None:
                odd = list(range(len(part)))
            else:
                odd = [i for i, t in enumerate(part) if any(s in t for s in self.special)]
            if not odd:
                yield (a, *self._batch(part, want_ids))
                continue
            skip = set(odd)
            counts = np.zeros(len(part), np.int64)
            rest = [i for i in range(len(part)) if i not in skip]
            got, ids = self._batch([part[i] for i in rest], want_ids) if rest else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
            counts[rest] = got
            lists: dict[int, np.ndarray] = {}
            if want_ids:
                edges = np.concatenate(([0], np.cumsum(got)))
                lists = {i: ids[edges[k] : edges[k + 1]] for k, i in enumerate(rest)}
            for i in odd:
                own = np.array(self._plain(part[i]), np.uint32)
                counts[i], lists[i] = len(own), own
            yield a, counts, np.concatenate([lists[i] for i in range(len(part))]) if want_ids else None


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; made once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    """Where the public tokenizer file of the registered queries lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
