"""Token counts at every prefix of a text, for byte-pair encodings that mark the ends of words.

The encoding of a string is that of the string without its last token, and that token. So the last
token of every prefix follows from those of shorter prefixes by dynamic programming: it is the one
token of the vocabulary that ends there and stays apart from the token before it when the two are
encoded together. A prefix that ends inside a word counts as if the word ended there, which is a second
table over the first, as the last symbol of a word is another symbol.

A text's table is the tables of its words laid end to end, as no merge crosses a word. It is stored as
the change of the count from one code point to the next, a signed byte each, so its sum over the first
n bytes is the number of tokens of the first n code points. Questions on truncation and budget are
answered from it (:func:`tokens_before`, :func:`longest_within`) without encoding anything again.

Defined results: a null text counts as empty and has no tokens. Every row gives one row, also under a
null or repeated id. An empty table gives none. Columns other than the two named are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import bound_batches, load, query

#: Texts of more tokens than this are over the limit.
LIMIT = 2048
#: Tables of words and pairs of tokens that a task remembers. Beyond it those of words not met since
#: the last time there were so many are forgotten, and all pairs.
REMEMBERED = 1 << 18

# Letters, numbers and white space among the characters below, as the tokenizer splits them.
LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\\t-\\r \x85\xa0"
#: Characters that are lower-cased one by one and never join their neighbours.
PLAIN = re.compile("[\x00-įı-ſ‐-‧€]*")
_CONTRACTION = "'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])"
_PIECES = re.compile(
    f"{_CONTRACTION}|[{LETTERS}]+|[{NUMBERS}]|[{SPACES}]+|[^{LETTERS}{NUMBERS}{SPACES}]+"
)
_CONTRACTED = re.compile(_CONTRACTION)
# Fixed value: what the tokenizer takes for white space.
_WHITE = re.compile("([\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+)")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in prints else chr(next(others)) for byte in range(256)]


@lru_cache(1)
def _joins_before() -> frozenset[str]:
    """Characters without a combining class that can still join the one before them."""
    found = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<") and not unicodedata.combining(chr(int(parts[1], 16))):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found | {chr(code) for code in range(0x1161, 0x11C3)})


class PrefixCounter:
    """Tables of token counts by prefix, for a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self._set_up(json.load(file))
        self.library = tokenizers.Tokenizer.from_file(path)
        self.lowered: dict[str, str] = {}

    def _set_up(self, named: dict) -> None:
        model = named["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.mark = model["end_of_word_suffix"] or ""
        self.vocabulary = set(model["vocab"])
        self.longest = max(map(len, self.vocabulary))
        if self.longest > 100:
            raise ValueError("the counts of neighbouring prefixes may differ by more than a signed byte holds")
        self.symbols = byte_symbols()
        specials = sorted((t["content"] for t in named["added_tokens"]), key=len, reverse=True)
        self.specials = specials
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        self.tables: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.spines: dict[str, tuple[list, list] | None] = {}
        self.line, self.lasts, self.counts, self.finals = "", [""], [0], []
        self.inside = _lengths(t for t in self.vocabulary if not (self.mark and t.endswith(self.mark)))
        self.ending = _lengths(t.removesuffix(self.mark) for t in self.vocabulary if t.endswith(self.mark))

    def _spines(self, token: str) -> tuple[list, list] | None:
        """The symbols at the right and the left edge while a token is made, each with the rank of the
        merge that ends it; none if the token's symbols do not merge into it."""
        if token not in self.spines:
            bare = token.removesuffix(self.mark) if self.mark else token
            parts = [*bare]
            parts[-1] += token[len(bare) :]
            never = len(self.ranks)
            right, left = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(pair, never), at) for at, pair in enumerate(zip(parts, parts[1:])))
                if rank == never:
                    break
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = ([*right, (token, never)], [*left, (token, never)])
            self.spines[token] = made if len(parts) == 1 else None
        return self.spines[token]

    def _stays(self, before: str, token: str) -> bool:
        """Whether two tokens in a row, or a token at a word's start, encode as themselves.

        Merges go by rank and from the left. So a pair across the border is merged just if both its
        symbols are still there when its rank comes.
        """
        key = (before, token)
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= REMEMBERED:
                self.apart.clear()
            known = self._spines(token) is not None
            if known and before:
                ranks = self.ranks
                for x, x_ends in self._spines(before)[0]:
                    for y, y_ends in self._spines(token)[1]:
                        rank = ranks.get((x, y))
                        if rank is not None and rank < x_ends and rank <= y_ends:
                            known = False
            self.apart[key] = known
        return known

    def _last(self, line: str, end: int, lasts: list[str], lengths: tuple[int, ...], mark: str) -> tuple[int, str]:
        """Where the last token of a prefix starts, and that token."""
        vocabulary, apart = self.vocabulary, self.apart
        for length in lengths:
            start = end - length
            if start >= 0:
                token = line[start:end] + mark
                if token in vocabulary:
                    known = apart.get((lasts[start], token))
                    if known or known is None and self._stays(lasts[start], token):
                        return start, token
        raise ValueError(f"the vocabulary lacks {line[end - 1] + mark!r}")

    def _word(self, word: str) -> list[int]:
        """The count at the end of each code point of a word, as if the word ended there.

        What the word shares with the start of the one before it is taken over from that.
        """
        line = "".join([self.symbols[byte] for byte in word.encode()])
        wanted = None if word.isascii() else set(accumulate(len(char.encode()) for char in word))
        shared = 0 if wanted else len(commonprefix((line, self.line)))
        lasts, counts, finals = self.lasts[: shared + 1], self.counts[: shared + 1], self.finals[:shared]
        self.line = ""
        inside, ending, mark, last = self.inside, self.ending, self.mark, self._last
        for end in range(shared + 1, len(line) + 1):
            tail = line[end - 3 : end] if end > 2 else line[:end]
            start, token = last(line, end, lasts, inside.get(tail, (2, 1)), "")
            if wanted is None or end in wanted:
                finals.append(counts[last(line, end, lasts, ending.get(tail, (2, 1)), mark)[0]] + 1)
            lasts.append(token)
            counts.append(counts[start] + 1)
        if wanted is None:
            self.line, self.lasts, self.counts, self.finals = line, lasts, counts, finals
        return finals[:]

    def _counts(self, piece: str) -> list[int]:
        """The counts at the prefixes of one lower-cased piece; a contraction is two words until it is whole."""
        counts = self._word(piece)
        if len(piece) > 2 and _CONTRACTED.fullmatch(piece):
            counts[1] = counts[0] + self._word(piece[1])[0]
        return counts

    def _kept(self, text: str, make: Callable[[str], bytes]) -> bytes:
        known = self.tables.get(text)
        if known is None:
            known = self.older.get(text)
            known = make(text) if known is None else known
            if len(self.tables) >= REMEMBERED:
                self.older, self.tables = self.tables, {}
            self.tables[text] = known
        return known

    def _piece(self, piece: str) -> bytes:
        """The changes of the count over a piece of plain characters, from the start of it on."""
        return self._kept(piece, self._plain)

    def _plain(self, piece: str) -> bytes:
        if _WHITE.fullmatch(piece):
            return bytes(len(piece))
        return _changes(self._counts(piece.lower()))

    def _normal(self, text: str) -> str:
        """Normalised by the library: composed, white space made one space, lower-cased."""
        return self.library.normalizer.normalize_str(text)

    def _pieces(self, normal: str) -> list[tuple[int, int]]:
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [at for _, at in found]

    def _unit(self, unit: str) -> bytes:
        """The changes over text without white space that has other than plain characters."""
        safe = [0]
        composed = unicodedata.is_normalized("NFC", unit)
        for at in range(1, len(unit)):
            char = unit[at]
            if composed or not (unicodedata.combining(char) or char in _joins_before()
                                or unicodedata.combining(unicodedata.normalize("NFD", char)[0])):
                safe.append(at)
        safe.append(len(unit))
        clusters = [unit[a:b] for a, b in zip(safe, safe[1:])]
        if len(self.lowered) >= REMEMBERED:
            self.lowered.clear()
        for cluster in clusters:
            if cluster not in self.lowered:
                self.lowered[cluster] = self._normal(cluster)
        normal = [self.lowered[cluster] for cluster in clusters]
        line = "".join(normal)
        counts, begins = [0], [0]
        for a, b in self._pieces(line):
            before = counts[-1]
            counts += [before + count for count in self._counts(line[a:b])]
            begins += [a] * (b - a)
        out, end = [], 0
        for cluster, part in zip(clusters, normal):
            for cut in range(1, len(cluster)):
                # Inside a cluster that would still change, the word so far is counted for itself.
                tail = line[begins[end] : end] + self._normal(cluster[:cut])
                out.append(counts[begins[end]] + sum(self._counts(tail[a:b])[-1] for a, b in self._pieces(tail)))
            end += len(part)
            out.append(counts[end])
        return _changes(out)

    def _part(self, text: str) -> bytes:
        """The changes over text without special tokens."""
        if PLAIN.fullmatch(text):
            tables = self.tables
            pieces = _PIECES.findall(text)
            return b"".join([tables[p] if p in tables else self._piece(p) for p in pieces])
        out = []
        for place, part in enumerate(_WHITE.split(text)):
            if place % 2:
                out.append(bytes(len(part)))
            elif PLAIN.fullmatch(part):
                out += map(self._piece, _PIECES.findall(part))
            else:
                out.append(self._kept(part, self._unit))
        return b"".join(out)

    def tables_of(self, texts: list[str]) -> list[bytes]:
        """The tables of several texts. New words are worked out in order of the alphabet."""
        pieces = [
            _PIECES.findall(text) if PLAIN.fullmatch(text) and not any(s in text for s in self.specials) else None
            for text in texts
        ]
        listed = set().union(*[found for found in pieces if found])
        for piece in sorted(piece for piece in listed if piece not in self.tables):
            self._piece(piece)
        tables = self.tables
        return [
            self.table(text) if found is None else b"".join([tables[p] if p in tables else self._piece(p) for p in found])
            for text, found in zip(texts, pieces)
        ]

    def table(self, text: str | None) -> bytes:
        """For each code point of a text, by how much the count changes at its end, as a signed byte."""
        text = text or ""
        out, begin = [], 0
        for found in self.special.finditer(text):
            # Until its last character a special token is text like any other.
            part = self._part(text[begin : found.end() - 1])
            counted = np.frombuffer(part, np.int8)[found.start() - begin :].sum(dtype=np.int64)
            out += [part, _changes([1 - int(counted)])]
            begin = found.end()
        out.append(self._part(text[begin:]))
        return b"".join(out)


def _changes(counts: list[int]) -> bytes:
    return bytes([(count - before) & 255 for before, count in zip([0, *counts], counts)])


def _lengths(tokens: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """By the last three symbols of tokens how long such tokens are; the longest first, and any may be short."""
    found: dict[str, set[int]] = {}
    for token in tokens:
        found.setdefault(token[-3:], {2, 1}).add(len(token))
    return {tail: tuple(sorted(lengths, reverse=True)) for tail, lengths in found.items()}


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens`` and ``changes``, its table of prefixes.

    ``path`` names a tokenizer file that every executor can read.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(path)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            tables = made.tables_of(texts)
            tokens = [int(np.frombuffer(table, np.int8).sum(dtype=np.int64)) for table in tables]
            sizes = [len(text.encode()) for text in texts]
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tables, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "changes"])

    made = rows.mapInArrow(work, f"id {kind}, n_bytes long, n_tokens long, changes binary")
    return made.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", "changes")


def _asked(changes, numbers, answer) -> Column:
    import pandas as pd

    def each(tables: pd.Series, asked: pd.Series) -> pd.Series:
        return pd.Series([answer(np.frombuffer(t, np.int8).cumsum(dtype=np.int64), n) for t, n in zip(tables, asked)])

    each.__annotations__ = {"tables": pd.Series, "asked": pd.Series, "return": pd.Series}
    return F.pandas_udf(each, "long")(changes, numbers)


def tokens_before(changes: Column, chars: Column) -> Column:
    """How many tokens the first ``chars`` code points of a text have, from its table."""

    def answer(counts: np.ndarray, asked: int) -> int:
        at = min(int(asked), len(counts))
        return int(counts[at - 1]) if at > 0 else 0

    return _asked(changes, F.coalesce(chars.cast("long"), F.lit(0)), answer)


def longest_within(changes: Column, budget: Column) -> Column:
    """The code points of the longest prefix that has at most ``budget`` tokens, from a text's table."""

    def answer(counts: np.ndarray, asked: int) -> int:
        fits = np.flatnonzero(counts <= asked)
        return int(fits[-1]) + 1 if len(fits) else 0

    return _asked(changes, F.coalesce(budget.cast("long"), F.lit(0)), answer)


@query()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    counts = prefix_counts(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
