"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words stand between white space, in lower case and without punctuation at either end; what is only
punctuation is no word. So case, line breaks and the marks around words do not matter. Scripts that are
written without spaces give a word for each two characters that follow each other. A seed is any
n-gram of a test item, all its words for an item of fewer; where it occurs in a document it lays the item against the words around it.
The local alignment of the two gives a score, as a share of what the item scores against itself,
which edited and paraphrased copies keep most of.

Items that share a common n-gram are not all aligned with a document that has it. An alignment has no
more matches than the item has words that occur in the document, so items that cannot reach their
least score by that count are left out first, all together. The count decides nothing else, so it
changes no result, and neither does the number of items in a block.

The items are the smaller side, but nothing bounds them: they come in blocks of at most about
``BLOCK_BYTES`` of text, and each block is sent to the tasks and joined with every document in one
pass. Documents are not moved at all, so common passages make no hot key, and all of a document's
words are searched.

Defined results: null texts have no words, and an item without words is never found. An item of up to
eight words is found only whole. Repeated documents give repeated
rows, repeated item ids one row of the best score. Empty tables give none. Null ids are kept as
they are. Other columns are not read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import bound_batches, load, query
from loadledger.work import cut_lineage

SEED_WORDS = 4
#: An aligned pair counts from this share of the item's own score, and from this many points.
LEAST_SHARE, LEAST_POINTS = 0.3, 16
#: From this many points on it counts whatever its share, so that long items hide no long passage.
ENOUGH_POINTS = 60
MATCH, MISMATCH, GAP = 2, -1, -1
#: Text of the items that is sent to the tasks at once.
BLOCK_BYTES = 4 << 20

#: Words of documents that are searched together, about.
_TOGETHER = 500_000
# Fixed value: the marks that are cut off at both ends of a word.
_MARKS = string.punctuation + "\u00a1\u00a7\u00ab\u00b6\u00bb\u00bf\u2013\u2014\u2018\u2019\u201c\u201d\u201e\u2026\u3001\u3002"
_MARKS += "\u3008\u3009\u300a\u300b\u300c\u300d\u300e\u300f\u3010\u3011\u30fb\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f"
# Thai, Lao, Myanmar, Khmer, kana, bopomofo and Han, which stand without spaces.
_UNSPACED = re.compile(
    "([\u0e01-\u0e4e\u0e81-\u0ecd\u1000-\u1049\u1050-\u109f\u1780-\u17d3\u3005-\u3007\u3041-\u3096\u309d-\u309f"
    "\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\uff66-\uff9f\U00020000-\U0003ffff]+)"
)
_UNKNOWN = -1


def words_of(text: str | None) -> list[str]:
    """The words; a run of a script without spaces gives each pair of neighbours, or its one character."""
    text = (text or "").lower()
    if text.isascii() or _UNSPACED.search(text) is None:
        return _bare(text)
    words = []
    for place, part in enumerate(_UNSPACED.split(text)):
        if place % 2:
            words += [part[k : k + 2] for k in range(max(1, len(part) - 1))]
        else:
            words += _bare(part)
    return words


def _bare(text: str) -> list[str]:
    return [word for word in map(str.strip, text.split(), repeat(_MARKS)) if word]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment's points, and the words of the passage it ends after and item's.

    One row per word of the item; gaps along a row are a running maximum.
    """
    slope = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best = (0, 0, 0)
    for place, word in enumerate(item, 1):
        step = np.where(passage == word, MATCH, MISMATCH)
        now = np.zeros_like(row)
        np.maximum(row[:-1] + step, row[1:] + GAP, out=now[1:])
        np.maximum(now, 0, out=now)
        row = np.maximum.accumulate(now + slope) - slope
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), end, place)
    return best


class Index:
    """The seeds of a block of items, and the items as numbered words."""

    def __init__(self, items: list[tuple]):
        listed = [(item_id, words_of(text)) for item_id, text in items]
        vocabulary = sorted({word for _, words in listed for word in words})
        self.number = {word: place for place, word in enumerate(vocabulary)}
        self.ids = [item_id for item_id, _ in listed]
        self.items = [np.array([self.number[w] for w in words], np.int64) for _, words in listed]
        self.seeds = {width: self._seeds(width) for width in sorted({min(len(i), SEED_WORDS) for i in self.items} - {0})}
        self.sizes = np.array([len(item) for item in self.items], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate([np.empty(0, np.int64), *self.items])
        own = MATCH * self.sizes
        self.least = np.maximum(np.minimum(LEAST_SHARE * own, ENOUGH_POINTS), np.minimum(LEAST_POINTS, own))
        # By the number of a word, and a last place for words of no item.
        self.present = np.zeros(len(vocabulary) + 1, bool)

    def _seeds(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The codes of the seeds of a width in order, with the item and the place of each."""
        chosen = [k for k, item in enumerate(self.items) if min(len(item), SEED_WORDS) == width]
        grams = [self._grams(self.items[k], width) for k in chosen]
        sizes = [len(g) for g in grams]
        codes = np.concatenate(grams)
        order = np.argsort(codes, kind="stable")
        places = np.concatenate([np.arange(n) for n in sizes])
        return codes[order], np.repeat(chosen, sizes)[order], places[order]

    @staticmethod
    def _grams(numbers: np.ndarray, width: int) -> np.ndarray:
        """A code for each n-gram of numbered words; unknown words are below 0 and give code 0."""
        count = len(numbers) - width + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        codes = np.zeros(count, np.uint64)
        known = np.ones(count, bool)
        for shift in range(width):
            part = numbers[shift : shift + count]
            codes = codes * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64) + np.uint64(1)
            known &= part >= 0
        return np.where(known, codes | np.uint64(1), np.uint64(0))

    def _numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.number.get, words, repeat(_UNKNOWN)), np.int64, len(words))

    def find(self, texts: Iterator[str | None]) -> Iterator[tuple]:
        """Items found in texts: the text's place, id, share of own score, first word, word after the last."""
        group, words = [], 0
        for place, text in enumerate(texts):
            group.append((place, self._numbers(text)))
            words += len(group[-1][1])
            if words >= _TOGETHER:
                yield from self._search(group)
                group, words = [], 0
        yield from self._search(group)

    def _search(self, group: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
        """Seeds are looked up for a group of texts at once; a gap of no words keeps texts apart."""
        gap = np.full(SEED_WORDS, _UNKNOWN, np.int64)
        line = np.concatenate([gap, *[part for _, numbers in group for part in (numbers, gap)]])
        starts = np.cumsum([SEED_WORDS, *[len(numbers) + SEED_WORDS for _, numbers in group]])
        laid: dict[tuple[int, int], set[int]] = {}
        for width in self.seeds:
            self._lay(width, group, line, starts, laid)
        found: dict = {}
        for (owner, which), places in laid.items():
            got = self._best(which, group[owner][1], sorted(places))
            key = (group[owner][0], self.ids[which])
            if got is not None and (key not in found or got > found[key]):
                found[key] = got
        return iter([(*key, *got) for key, got in found.items()])

    def _lay(self, width: int, group: list, line: np.ndarray, starts: np.ndarray, laid: dict) -> None:
        """Adds where seeds of a width lay items against the texts of a group, by text and item."""
        known, item_of, place_of = self.seeds[width]
        codes = self._grams(line, width)
        at = np.flatnonzero(codes)
        low = np.searchsorted(known, codes[at], "left")
        high = np.searchsorted(known, codes[at], "right")
        hits = high > low
        at, low, high = at[hits], low[hits], high[hits]
        owners = np.searchsorted(starts, at, "right") - 1
        firsts = np.flatnonzero(np.diff(owners, prepend=-1)).tolist()
        for begin, end in zip(firsts, [*firsts[1:], len(owners)]):
            owner = int(owners[begin])
            fit = self._fit(group[owner][1], item_of, low[begin:end], high[begin:end])
            places = (at[begin:end] - starts[owner]).tolist()
            for place, a, b in zip(places, low[begin:end].tolist(), high[begin:end].tolist()):
                ks = a + np.flatnonzero(fit[item_of[a:b]])
                for which, shift in zip(item_of[ks].tolist(), place_of[ks].tolist()):
                    laid.setdefault((owner, which), set()).add(place - shift)

    def _fit(self, numbers: np.ndarray, item_of: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """By item, whether a seed of the ranges is its own and enough of its words occur in the text."""
        fit = np.zeros(len(self.items), bool)
        for a, b in set(zip(low.tolist(), high.tolist())):
            fit[item_of[a:b]] = True
        which = np.flatnonzero(fit)
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        words = np.arange(ends[-1]) + np.repeat(self.begins[which] - (ends - sizes), sizes)
        shared = np.add.reduceat(self._occurs(self.words[words], numbers), ends - sizes, dtype=np.int64)
        fit[which] = MATCH * shared >= self.least[which]
        return fit

    def _occurs(self, words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether each word, all of them of items, is one of the numbers of a text."""
        self.present[numbers] = True
        self.present[_UNKNOWN] = False
        occurs = self.present[words]
        self.present[numbers] = False
        return occurs

    def _best(self, which: int, numbers: np.ndarray, starts: list[int]) -> tuple | None:
        item, least = self.items[which], self.least[which]
        slack = len(item) // 2 + SEED_WORDS
        own = MATCH * len(item)
        best = None
        first = last = None
        spans = []
        for start in starts:
            a, b = max(0, start - slack), min(len(numbers), start + len(item) + slack)
            if last is not None and a <= last:
                last = max(last, b)
                continue
            if last is not None:
                spans.append((first, last))
            first, last = a, b
        spans.append((first, last))
        for a, b in spans:
            if MATCH * np.count_nonzero(self._occurs(item, numbers[a:b])) < least:
                continue
            points, end, item_end = align(item, numbers[a:b])
            if points < least or (best is not None and points / own <= best[0]):
                continue
            # The same alignment backwards from its end gives where it starts.
            _, length, _ = align(item[:item_end][::-1], numbers[a : a + end][::-1])
            best = (points / own, a + end - length, a + end)
        return best


def blocks_of(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded text, one at a time."""
    rows = cut_lineage(
        items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.octet_length(text_col).alias("n"))
    )
    total = rows.agg(F.sum("n")).first()[0] or 0
    count = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    for number in range(count):
        yield [(row.id, row.text) for row in rows.where(block == number).orderBy("id", "text").collect()]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item found in it: ``score``, and its words by place."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = [rows.schema["id"].dataType, items.schema[item_col].dataType]
    shape = f"id {kinds[0].simpleString()}, item {kinds[1].simpleString()}, score double, first long, after long"
    context = rows.sparkSession.sparkContext
    found = []
    for block in blocks_of(items, item_col, item_text_col, block_bytes):
        index = context.broadcast(Index(block))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = list(index.value.find(text.as_py() for text in batch.column(1)))
                at = pa.array([m[0] for m in made], pa.int64())
                columns = [pa.array([m[c] for m in made], t) for c, t in enumerate(types, 1)]
                columns = [batch.column(0).take(at), *columns]
                yield pa.RecordBatch.from_arrays(columns, ["id", "item", "score", "first", "after"])

        types = [_arrow_type(kinds[1]), pa.float64(), pa.int64(), pa.int64()]
        found.append(rows.mapInArrow(search, shape))
    return reduce(DataFrame.unionByName, found).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "first", "after"
    )


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without those in which a test item was found.

    The verdict on a row is a condition on its text, one for each block of items. So no row moves.
    """
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    named = items.select(F.col(item_text_col).alias("text")).distinct()
    for block in blocks_of(named.withColumn("id", F.xxhash64("text")), "id", "text", block_bytes):
        docs = docs.where(_free_of(context.broadcast(Index(block)))(docs[text_col]))
    return docs


def _free_of(index):
    """Whether a text has none of the items of a broadcast index."""

    @F.pandas_udf("boolean")
    def free(texts: pd.Series) -> pd.Series:
        found = {place for place, *_ in index.value.find(texts)}
        return pd.Series([place not in found for place in range(len(texts))], dtype=bool)

    return free


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text")
    )
