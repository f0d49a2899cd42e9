"""Alignment of two tokenizers over the same texts, token by token.

Both sides cut the bytes of a space and the text. Per batch, tokens lie in one frame a side, keyed by
document, and ``pandas.merge_asof`` finds for each token's start the other side's token that covers
it. Two tokens overlap just if one covers the other's start, so the union of both directions has all
overlaps; of these, the ones whose ends are equal close a group. Groups are the smallest stretches
that both sides cut out whole, and two tokens of different sides are linked if they share a group.

Neither side's tokens span the start of a space that follows something else, so texts are cut there into
words that are aligned apart. A task lays the words it has not met end to end, aligns these as above, and
remembers what each came to; documents are put together from that. A text with a word that a side cannot
give back, or with a mark that stands for a space, is aligned whole.

How many documents hold an id pair linked is counted over all documents. A batch of documents is a
block: it lists its distinct pairs once, with how many of its documents hold each, and its documents
refer to that list. Only these lists are shuffled, out to be summed by pair and back to their block, so
what moves is one row per block and distinct pair whatever a text repeats, and no text moves.

Defined results: a null or empty text has no tokens, and neither has one that a side cannot give back
byte for byte; all its figures are zero and its groups are empty. Every row gives one row and counts as
a document of its own, also under a null or repeated id. An empty table gives none. Columns other than
the two named are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loadledger.llm.registry import bound_batches, load, query
from loadledger.llm.tokens import LETTERS, NUMBERS, PLAIN, SPACES, byte_symbols
from loadledger.work import cut_lineage

#: Words whose tokens a task remembers, and an eighth of their tokens; all are forgotten when there are more.
REMEMBERED = 1 << 18
#: Bytes of text that are aligned at once, about; these documents are a block.
TOGETHER = 2 << 20
#: Groups with more links than this list their distinct ids before these are paired.
_LARGE = 256
#: Ids of either side are below this.
_IDS = 1 << 16
#: New words that are encoded as one line.
_ABREAST = 32
# Fixed value: how the byte-level tokenizer splits text, over plain characters.
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{LETTERS}{NUMBERS}{SPACES}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
# A text without these, and without a space first, last or behind a line's end, has words between single spaces.
_UNEVEN = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)


def words_of(text: str) -> list[str]:
    """A text cut at each space that follows something other than white space, but not at its last character."""
    uneven = " " in (text[:1], text[-1:]) or "  " in text or "\n " in text or _UNEVEN.search(text)
    return _CUT.split(text) if uneven else text.split(" ")


class _Side:
    """Encodes texts by words where these do not depend on each other. Words recur, so the library sees each
    once, and what is remembered of it is bytes, which Python's garbage collector need not visit."""

    bytes: list[bytes]
    #: Whether words are encoded apart as they are in a text.
    apart: bool

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text behind a space; none for a text that they do not give back byte for byte."""
        split = [self._words(text) for text in texts]
        words = list(chain.from_iterable(filter(None, split)))
        parts = list(map(self.known.get, words))
        new = list({word for word, part in zip(words, parts) if part is None})
        # A word that is not given back is empty, and its text is looked at as a whole.
        fresh = {
            word: array("H", ids).tobytes() if self._gives(ids, self._whole(word)) else b""
            for word, ids in zip(new, self._batch(new))
        }
        parts = [fresh[word] if part is None else part for word, part in zip(words, parts)]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
        self.known.update(fresh)
        out: list[np.ndarray | None] = [None] * len(texts)
        others, end = [], 0
        for place, found in enumerate(split):
            begin, end = end, end + len(found or ())
            if found is None or b"" in parts[begin:end]:
                others.append(place)
            else:
                out[place] = np.frombuffer(b"".join(parts[begin:end]), np.uint16)
        for place, ids in zip(others, self.whole([texts[place] for place in others])):
            out[place] = ids
        return out

    def whole(self, texts: list[str]) -> list[np.ndarray | None]:
        """The same, with every text given to the library as it is."""
        return [
            np.array(ids, np.uint16) if self._gives(ids, b" " + text.encode()) else None
            for ids, text in zip(self._texts(texts), texts)
        ]

    def _gives(self, ids: list[int], whole: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == whole


class ByteSide(_Side):
    """A byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            named = json.load(file)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.bytes = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for token, number in named["model"]["vocab"].items():
            self.bytes[number] = bytes(byte_of[symbol] for symbol in token)
        cut = named["pre_tokenizer"] or {}
        as_it_is = named["normalizer"] is None and all(token["special"] for token in named["added_tokens"])
        regular = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
        self.apart = as_it_is and regular

    def _batch(self, words: list[str]) -> list[list[int]]:
        return [made.ids for made in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _texts(self, texts: list[str]) -> list[list[int]]:
        return self._batch([" " + text for text in texts])

    def _words(self, text: str) -> list[str] | None:
        return _WORDS.findall(" " + text) if PLAIN.fullmatch(text) else None

    @staticmethod
    def _whole(word: str) -> bytes:
        return word.encode()


class PieceSide(_Side):
    """A model file of the sentencepiece library, which adds the space itself."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(number) for number in range(self.library.vocab_size())]
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.library.is_byte(number) else piece.replace("▁", " ").encode()
            for number, piece in enumerate(names)
        ]
        self.apart = self._merges() and all("▁" not in piece[1:] or not piece.strip("▁") for piece in names)

    def _merges(self) -> bool:
        """Whether the model merges pairs of the text as it is, so that what no piece spans is encoded apart."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        trained, normal = model.trainer_spec, model.normalizer_spec
        plain = all(piece.type not in (piece.USER_DEFINED, piece.UNUSED) for piece in model.pieces)
        as_it_is = not normal.precompiled_charsmap and not normal.remove_extra_whitespaces
        in_front = normal.add_dummy_prefix and normal.escape_whitespaces and not trained.treat_whitespace_as_suffix
        return trained.model_type == trained.BPE and plain and as_it_is and in_front

    def _batch(self, words: list[str]) -> list[list[int]]:
        return self.library.encode(words, num_threads=1)

    _texts = _batch

    def _words(self, text: str) -> list[str] | None:
        """What single spaces part: only runs of spaces are pieces that go on behind one."""
        single = self.apart and text and "  " not in text and " " not in (text[0], text[-1])
        return text.split(" ") if single and PLAIN.fullmatch(text) else None

    @staticmethod
    def _whole(word: str) -> bytes:
        return b" " + word.encode()


@lru_cache(2)
def _side(path: str) -> ByteSide | PieceSide:
    side = PieceSide(path) if path.endswith(".model") else ByteSide(path)
    if len(side.bytes) > _IDS:
        raise ValueError(f"{path} has more than {_IDS} ids")
    return side


class Aligned:
    """A batch of texts cut by both sides: token arrays in text order, and the group of each token.

    Groups are numbered through the batch; ``group_doc`` says whose they are.
    """

    def __init__(self, texts: list[str | None], a: ByteSide | PieceSide, b: ByteSide | PieceSide, whole: bool = False):
        made = [text or "" for text in texts]
        self.docs = len(made)
        both = enumerate(zip(*(side.whole(made) if whole else side.encode(made) for side in (a, b))))
        found = [(p, *ids) for p, ids in both if made[p] and all(side is not None for side in ids)]
        self.found = [p for p, *_ in found]
        self.a, a_frame = _frame(found, 1, a, "a")
        self.b, b_frame = _frame(found, 2, b, "b")
        # Each start finds the token that covers it; of two equal starts either covers the other. Documents
        # lie end to end on both sides, so only a token without bytes could find one of the next document.
        empty = any((frame["start"] == frame["end"]).any() for frame in (a_frame, b_frame))
        by = "doc" if empty else None
        ahead = pd.merge_asof(a_frame, b_frame, on="start", by=by)
        back = pd.merge_asof(b_frame, a_frame, on="start", by=by)
        i = np.concatenate([ahead["a"].to_numpy(np.int64), back["a"].to_numpy(np.int64)])
        j = np.concatenate([ahead["b"].to_numpy(np.int64), back["b"].to_numpy(np.int64)])
        a_ends, b_ends = a_frame["end"].to_numpy(), b_frame["end"].to_numpy()
        closing = a_ends[i] == b_ends[j]
        # Groups follow each other, so the closed ones before a token number its group.
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[i[closing]] = True
        last_b[j[closing]] = True
        self.a_group = np.cumsum(last_a) - last_a
        self.b_group = np.cumsum(last_b) - last_b
        self.group_doc, self.group_ends = a_frame["doc"].to_numpy()[last_a], a_ends[last_a]
        groups = len(self.group_doc)
        self.a_sizes = np.bincount(self.a_group, minlength=groups)
        self.b_sizes = np.bincount(self.b_group, minlength=groups)

    def part(self, sizes: list[int]) -> None:
        """Take for documents the words, of so many bytes, that lie end to end in the texts found."""
        self.docs = len(sizes)
        self.group_doc = np.searchsorted(np.cumsum(sizes), self.group_ends)

    def _per_doc(self, of_groups: np.ndarray) -> np.ndarray:
        out = np.zeros(self.docs, np.int64)
        np.add.at(out, self.group_doc, of_groups)
        return out

    def figures(self) -> dict[str, np.ndarray]:
        sizes, others = self.a_sizes.astype(np.int64), self.b_sizes.astype(np.int64)
        ones = np.ones(len(sizes), np.int64)
        counted = {"n_a": sizes, "n_b": others, "n_groups": ones, "n_links": sizes * others}
        return {name: self._per_doc(values) for name, values in counted.items()}

    def lines(self) -> list[bytes]:
        """Of each document its groups, written out; empty without tokens."""
        ids, kinds, docs = self._in_order()
        parts = list(map(_written().__getitem__, (kinds * _IDS + ids).tolist()))
        bounds = np.searchsorted(docs, np.arange(self.docs + 1)).tolist()
        return [b"".join(parts[x:y])[1:] for x, y in zip(bounds, bounds[1:])]

    def digests(self) -> list[str]:
        """Of each document its groups, written out and hashed; empty without tokens."""
        return _hashed(self.lines())

    def _in_order(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides by group, ours first, with what goes before them and their document."""
        n_a, n_b = len(self.a), len(self.b)
        a_through, b_through = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)
        a_at = np.arange(n_a) + (b_through - self.b_sizes)[self.a_group]
        b_at = np.arange(n_b) + a_through[self.b_group]
        ids, kinds, docs = (np.empty(n_a + n_b, np.int64) for _ in range(3))
        for at, side, group, kind in ((a_at, self.a, self.a_group, 0), (b_at, self.b, self.b_group, 1)):
            ids[at] = side
            kinds[at] = np.where(np.diff(group, prepend=-1) > 0, kind, 2)
            docs[at] = self.group_doc[group]
        return ids, kinds, docs

    def groups(self) -> list[list[dict]]:
        """Of each document its groups, each with the ids of both sides in order."""
        a_ends, b_ends = np.cumsum(self.a_sizes).tolist(), np.cumsum(self.b_sizes).tolist()
        out: list[list[dict]] = [[] for _ in range(self.docs)]
        a_from = b_from = 0
        for doc, a_end, b_end in zip(self.group_doc.tolist(), a_ends, b_ends):
            out[doc].append({"a": self.a[a_from:a_end].tolist(), "b": self.b[b_from:b_end].tolist()})
            a_from, b_from = a_end, b_end
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, pair) codes in order, and how many links each stands for."""
        large = self.a_sizes * self.b_sizes > _LARGE
        mine = np.flatnonzero(~large[self.a_group])
        per = self.b_sizes[self.a_group[mine]]
        begins = (np.cumsum(self.b_sizes) - self.b_sizes)[self.a_group[mine]]
        steps = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        theirs = self.b[np.repeat(begins, per) + steps]
        docs = self.group_doc[self.a_group[mine]]
        codes = [_code(np.repeat(docs, per), np.repeat(self.a[mine], per), theirs)]
        times = [np.ones(len(codes[0]), np.int64)]
        a_ends, b_ends = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)
        for group in np.flatnonzero(large).tolist():
            ours, n = np.unique(self.a[a_ends[group] - self.a_sizes[group] : a_ends[group]], return_counts=True)
            others, m = np.unique(self.b[b_ends[group] - self.b_sizes[group] : b_ends[group]], return_counts=True)
            doc = np.full(len(ours) * len(others), self.group_doc[group])
            codes.append(_code(doc, np.repeat(ours, len(others)), np.tile(others, len(ours))))
            times.append(np.outer(n, m).ravel())
        return _distinct(np.concatenate(codes), np.concatenate(times))


def _frame(found: list[tuple], which: int, side: ByteSide | PieceSide, name: str) -> tuple[np.ndarray, pd.DataFrame]:
    """The ids of one side, and its tokens by number, document, start and end; documents lie end to end."""
    ids = np.concatenate([np.empty(0, np.int64), *[row[which] for row in found]]).astype(np.int64)
    counts = np.array([len(row[which]) for row in found], np.int64)
    ends = np.cumsum(np.array([len(token) for token in side.bytes], np.int64)[ids])
    starts = np.concatenate([[0], ends[:-1]])[: len(ends)].astype(np.int64)
    docs = np.repeat(np.array([row[0] for row in found], np.int64), counts)
    return ids, pd.DataFrame({name: np.arange(len(ids)), "doc": docs, "start": starts, "end": ends})


def _hashed(lines: list[bytes]) -> list[str]:
    return [hashlib.sha256(line).hexdigest() if line else "" for line in lines]


def _distinct(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(codes, return_inverse=True)
    counted = np.zeros(len(distinct), np.int64)
    np.add.at(counted, place, times)
    return distinct, counted


def _code(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (doc * _IDS + a) * _IDS + b


@lru_cache(1)
def _written() -> list[bytes]:
    """Every id behind the mark that opens a group, the one between sides, and the one between ids."""
    return [b"%c%d" % (mark, number) for mark in b";|," for number in range(_IDS)]


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class _Table:
    """What stretches of text came to: their groups written out, their figures, their distinct pairs and links."""

    def __init__(self, lines: list[bytes], *columns: np.ndarray):
        self.lines = lines
        self.figures, self.n_pairs, self.pairs, self.times = columns

    @classmethod
    def of(cls, aligned: Aligned) -> _Table:
        codes, times = aligned.links()
        doc, pairs = np.divmod(codes, _IDS * _IDS)
        figures = aligned.figures()
        stacked = np.stack([figures[name] for name in _FIGURES], axis=1)
        return cls(aligned.lines(), stacked, np.bincount(doc, minlength=aligned.docs), pairs, times)

    def __add__(self, other: _Table) -> _Table:
        both = ("figures", "n_pairs", "pairs", "times")
        return _Table(self.lines + other.lines, *(np.concatenate([getattr(self, k), getattr(other, k)]) for k in both))


class Assembled:
    """A batch of texts put together from stretches of a table, each of which ends a group on both sides."""

    def __init__(self, table: _Table, stretches: np.ndarray, counts: np.ndarray):
        self.table, self.stretches, self.counts, self.docs = table, stretches, counts, len(counts)
        self.doc = np.repeat(np.arange(self.docs), counts)

    def figures(self) -> dict[str, np.ndarray]:
        out = np.zeros((self.docs, len(_FIGURES)), np.int64)
        some = self.counts > 0
        if some.any():
            begins = (np.cumsum(self.counts) - self.counts)[some]
            out[some] = np.add.reduceat(self.table.figures[self.stretches], begins)
        return dict(zip(_FIGURES, out.T))

    def digests(self) -> list[str]:
        parts = list(map(self.table.lines.__getitem__, self.stretches.tolist()))
        bounds = np.cumsum([0, *self.counts]).tolist()
        return _hashed([b";".join(parts[x:y]) for x, y in zip(bounds, bounds[1:])])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, pair) codes in order, and how many links each stands for."""
        of = self.table
        per = of.n_pairs[self.stretches]
        begins = (np.cumsum(of.n_pairs) - of.n_pairs)[self.stretches]
        places = np.repeat(begins - (np.cumsum(per) - per), per) + np.arange(per.sum())
        return _distinct(np.repeat(self.doc, per) * (_IDS * _IDS) + of.pairs[places], of.times[places])


class Words:
    """Aligns texts word by word, and remembers what the words came to."""

    def __init__(self, a: ByteSide | PieceSide, b: ByteSide | PieceSide):
        self.a, self.b = a, b
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        # Row 0 stands for every word without tokens.
        none = np.zeros(0, np.int64)
        self.table = _Table([b""], np.zeros((1, len(_FIGURES)), np.int64), np.zeros(1, np.int64), none, none)

    def align(self, texts: list[str | None]) -> Assembled:
        made = [text or "" for text in texts]
        if max(len(self.known), int(self.table.figures[:, :2].sum()) // 8) > REMEMBERED:
            self._forget()
        split = [words_of(text) if text and self._cut(text) else [] for text in made]
        counts = np.array(list(map(len, split)), np.int64)
        words = list(chain.from_iterable(split))
        numbers = np.array(list(map(self.known.get, words, repeat(-1))), np.int64)
        new = np.flatnonzero(numbers < 0).tolist()
        self._learn(list(dict.fromkeys(words[place] for place in new)))
        numbers[new] = [self.known[words[place]] for place in new]
        # Where a word has no tokens, the text is looked at as a whole, and so is one that is not cut.
        doc = np.repeat(np.arange(len(made)), counts)
        whole = np.array([bool(text) for text in made], bool) & (counts == 0)
        whole[doc[numbers == 0]] = True
        if not whole.any():
            return Assembled(self.table, numbers, counts)
        others = np.flatnonzero(whole)
        table = self.table + _Table.of(Aligned([made[place] for place in others.tolist()], self.a, self.b))
        kept = ~whole[doc]
        stretches = np.concatenate([numbers[kept], len(self.table.lines) + np.arange(len(others))])
        order = np.argsort(np.concatenate([doc[kept], others]), kind="stable")
        return Assembled(table, stretches[order], np.where(whole, 1, counts))

    def _cut(self, text: str) -> bool:
        return self.a.apart and self.b.apart and "▁" not in text

    def _learn(self, words: list[str]) -> None:
        """Align words laid end to end. One that ends in white space could join the next, so it is a line's last."""
        inner = [word for word in words if not word[-1].isspace()]
        lines = [inner[begin : begin + _ABREAST] for begin in range(0, len(inner), _ABREAST)]
        lost = self._lay([*lines, *([word] for word in words if word[-1].isspace())])
        # A line that is not given back has a word that is not.
        self._lay([[word] for line in lost if len(line) > 1 for word in line])
        for word in words:
            self.known.setdefault(word, 0)

    def _lay(self, lines: list[list[str]]) -> list[list[str]]:
        """Align lines of words, remember these, and give back the lines without tokens."""
        aligned = Aligned([" ".join(line) for line in lines], self.a, self.b, whole=True)
        words = list(chain.from_iterable(lines[place] for place in aligned.found))
        aligned.part([len(word.encode()) + 1 for word in words])
        self.known.update(zip(words, range(len(self.table.lines), len(self.table.lines) + len(words))))
        self.table += _Table.of(aligned)
        found = set(aligned.found)
        return [line for place, line in enumerate(lines) if place not in found]


@lru_cache(1)
def _words(a_path: str, b_path: str) -> Words:
    return Words(_side(a_path), _side(b_path))


def _blocks(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per batch: its documents' own figures, its distinct pairs, and which documents hold which.

    ``gaps`` are the steps from one pair of a document to its next in ``pairs``, ``times`` the links.
    """
    kind = rows.schema["id"].dataType
    fields = ", ".join(f"{name}: bigint" for name in _FIGURES)
    docs_type = f"array<struct<id: {kind.simpleString()}, {fields}, groups_sha256: string, n_pairs: bigint>>"
    shape = f"block long, docs {docs_type}, gaps array<int>, times array<int>, pairs array<bigint>, holders array<int>"
    id_type = to_arrow_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(a_path, b_path)
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(_pieces(batches)):
            aligned = words.align(batch.column(1).to_pylist())
            codes, times = aligned.links()
            holder, pair = np.divmod(codes, _IDS * _IDS)
            pairs, place = np.unique(pair, return_inverse=True)
            n_pairs = np.bincount(holder, minlength=aligned.docs)
            gaps = np.diff(place, prepend=0)
            firsts = np.flatnonzero(np.diff(holder, prepend=-1))
            gaps[firsts] = place[firsts]
            figures = aligned.figures()
            columns = [batch.column(0).cast(id_type), *[pa.array(figures[name]) for name in _FIGURES],
                       pa.array(aligned.digests(), pa.string()), pa.array(n_pairs, pa.int64())]
            docs = pa.StructArray.from_arrays(columns, [*["id", *_FIGURES], "groups_sha256", "n_pairs"])
            lists = [docs, pa.array(gaps, pa.int32()), pa.array(times, pa.int32()), pa.array(pairs, pa.int64()),
                     pa.array(np.bincount(place, minlength=len(pairs)), pa.int32())]
            listed = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in lists]
            block = pa.array([(part << 32) + number], pa.int64())
            yield pa.RecordBatch.from_arrays([block, *listed], ["block", "docs", "gaps", "times", "pairs", "holders"])

    return rows.mapInArrow(work, shape)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text; a longer text is one of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // TOGETHER
        starts = np.flatnonzero(np.diff(piece, prepend=-1)).tolist()
        for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(begin, end - begin)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Every id pair that is linked anywhere: ``pair``, in how many documents, and if its A id has no better."""
    listed = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("_of"))
    counts = listed.groupBy(F.col("_of.pairs").alias("pair")).agg(F.sum("_of.holders").alias("count"))
    counts = cut_lineage(counts.withColumn("a", F.shiftright("pair", 16)))
    highest = counts.groupBy("a").agg(F.max("count").alias("_most"))
    best = F.col("count") == F.col("_most")
    return counts.join(highest, "a").select("pair", "a", F.col("pair").bitwiseAND(_IDS - 1).alias("b"), "count", best.alias("best"))


def alignment(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, and the links' corpus-wide counts.

    The paths name tokenizer files that every executor can read: ``.model`` for sentencepiece, else a
    byte-level one of the tokenizers library.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = cut_lineage(_blocks(rows, a_path, b_path))
    counts = cut_lineage(pair_counts(blocks).select("pair", "count", "best"))
    listed = blocks.select("block", F.posexplode("pairs").alias("_at", "pair"))
    back = listed.join(counts, "pair").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("_at", "count", "best"))).alias("_known")
    )
    known = back.select(F.col("block").alias("_block"), F.col("_known.count").alias("counts"), F.col("_known.best").alias("best"))
    whole = blocks.select("block", "docs", "gaps", "times").join(known, F.col("block") == F.col("_block"), "left")
    names = ["id", *_FIGURES, "n_best", "count_sum", "groups_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, gaps, times, counts, best = (batch.column(k).slice(row, 1).flatten() for k in range(5))
                made = dict(zip([field.name for field in docs.type], docs.flatten()))
                n_pairs = made["n_pairs"].to_numpy()
                place = _places(gaps.to_numpy(), n_pairs)
                times, counts = times.to_numpy().astype(np.int64), counts.to_numpy()
                best = best.to_numpy(zero_copy_only=False).astype(bool)
                holder = np.repeat(np.arange(len(n_pairs)), n_pairs)
                n_best, total = np.zeros(len(n_pairs), np.int64), np.zeros(len(n_pairs), np.int64)
                np.add.at(n_best, holder, times * best[place])
                np.add.at(total, holder, times * counts[place])
                made |= {"n_best": pa.array(n_best), "count_sum": pa.array(total)}
                yield pa.RecordBatch.from_arrays([made[name] for name in names], names)

    fields = ", ".join(f"{name} long" for name in names[1:-1])
    made = whole.select("docs", "gaps", "times", "counts", "best").mapInArrow(
        work, f"id {kind}, {fields}, groups_sha256 string"
    )
    return made.select(F.col("id").alias(id_col), *names[1:])


def _places(gaps: np.ndarray, n_pairs: np.ndarray) -> np.ndarray:
    """What steps add up to, from zero again for each document."""
    sums = np.cumsum(gaps, dtype=np.int64)
    begins = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
    before = sums[begins] - gaps[begins]
    return sums - np.repeat(before, n_pairs[n_pairs > 0])


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``groups``, each with the ids ``a`` and ``b`` of both sides."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    listed = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            made = Aligned(batch.column(1).to_pylist(), _side(a_path), _side(b_path)).groups()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, listed)], ["id", "groups"])

    made = rows.mapInArrow(work, f"id {kind}, groups array<struct<a: array<int>, b: array<int>>>")
    return made.select(F.col("id").alias(id_col), "groups")


@query()
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    return alignment(documents, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
