"""Removal of repeated passages: bytes of strings that also start in an earlier document.

Every string of ``LENGTH`` bytes has an anchor, the least hash of the short grams in it, so equal
strings have equal anchors wherever they stand. Strings that follow one another and share an anchor
form a stretch. Three exchanges go over the documents, which are written once in batches:

1. Each batch sends its anchors, once each, to shards by hash, and learns which occur in more than
   one document. Most text ends here.
2. Each batch sends the stretches of those anchors, each distinct one once with its smallest id. A
   shard puts its distinct stretches together, sorts their suffixes by induced sorting, and takes
   runs of starts with a common prefix of the full length as equal strings. The answer to a batch
   is a bit for each string: whether a smaller id than the batch's own has it.
3. Each batch works out the covered bytes of its documents.

What a shard gets is one entry per batch for an anchor or a distinct stretch, so a passage that a
third of all documents share is no hot key. Batches, shards and messages are bounded in size and
grow in number with the input; nothing is gathered in the driver but sums.

Defined results: a null text is empty; a null id counts as larger than any other, and rows of equal
ids are not earlier than each other. Texts shorter than a string lose nothing. An empty table gives
none. Ids must be whole numbers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import bound_batches, load, query
from loadledger.llm.suffix import common_prefixes, suffix_array
from loadledger.work import cut_lineage

LENGTH = 50
#: Bytes of the grams that are hashed to choose anchors.
GRAM = 20
#: Text in a batch, and text of the corpus per shard, about.
BATCH_BYTES, SHARD_BYTES = 6 << 20, 4 << 20
#: Starts whose anchors are worked out together.
_CHUNK = 1 << 19
#: How hard messages and batches are compressed; they are written and moved several times.
_LEVEL = 4
_NO_ID = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15
_SHARD_OF_INDEX = -1

_BATCHES = "batch long, ids binary, sizes binary, missing binary, bytes long, packed binary"
_MESSAGES = "shard long, batch long, kind int, content binary"
_PARTS = ["shard", "batch", "kind", "content"]


def _squeeze(raw: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=_LEVEL).compress(raw, asbytes=True)


def _expand(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, codec="zstd", asbytes=True)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes: equal bytes of neighbouring numbers stand together."""
    out = []
    for array in arrays:
        raw = np.ascontiguousarray(array)
        planes = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T
        packed = _squeeze(np.ascontiguousarray(planes).tobytes()) if len(raw) else b""
        out.append(np.array([len(raw), len(packed)], np.int64).tobytes() + packed)
    return b"".join(out)


def _unpack(content: bytes, *kinds: type) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        count, size = np.frombuffer(content, np.int64, 2, at).tolist()
        at += 16
        width = np.dtype(kind).itemsize
        if count:
            raw = _expand(content[at : at + size], count * width)
            planes = np.frombuffer(raw, np.uint8).reshape(width, count)
            out.append(np.ascontiguousarray(planes.T).view(kind).reshape(count))
        else:
            out.append(np.empty(0, kind))
        at += size
    return out


def _batched(rows: DataFrame, batch_bytes: int) -> DataFrame:
    """Documents in rows of many, each a batch with a number of its own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            kept = np.array([0 if i is None else i for i in ids], np.int64)
            missing = np.array([i is None for i in ids], np.uint8)
            sizes = np.array([len(text) for text in texts], np.int64)
            packed = _squeeze(b"".join(texts)) if size else b""
            values = [number, _pack(kept), _pack(sizes), _pack(missing), size, packed]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            names = ["batch", "ids", "sizes", "missing", "bytes", "packed"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1])
                if size >= batch_bytes:
                    yield row()
                    number += 1
                    ids, texts, size = [], [], 0
        if ids:
            yield row()

    return rows.mapInArrow(work, _BATCHES)


class _Batch:
    """A batch of documents as one array of bytes, and its stretches."""

    def __init__(self, row: dict):
        (ids,), (self.sizes,) = _unpack(row["ids"], np.int64), _unpack(row["sizes"], np.int64)
        (missing,) = _unpack(row["missing"], np.uint8)
        self.missing = missing.astype(bool)
        self.ids = ids
        self.order = np.where(self.missing, _NO_ID, ids)
        raw = _expand(row["packed"], row["bytes"]) if row["bytes"] else b""
        self.bytes = np.frombuffer(raw, np.uint8)
        self.ends = np.cumsum(self.sizes)

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, first start, number of starts and place of the document, per stretch."""
        room = np.zeros(len(self.bytes) + 1, np.int32)
        np.add.at(room, np.maximum(self.ends - self.sizes, self.ends - LENGTH + 1), 1)
        np.add.at(room, self.ends, -1)
        fits = np.cumsum(room[:-1], dtype=np.int32) == 0
        found = [_stretches(self.bytes, fits, at) for at in range(0, max(0, len(fits) - LENGTH + 1), _CHUNK)]
        anchors, starts, counts = (
            np.concatenate([np.empty(0, k), *[part[n] for part in found]])
            for n, k in enumerate((np.uint64, np.int64, np.int64))
        )
        return anchors, starts, counts, np.searchsorted(self.ends, starts, "right")


def _stretches(data: np.ndarray, fits: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches among the starts of one chunk."""
    piece = data[at : at + _CHUNK + LENGTH - 1]
    count = len(piece) - LENGTH + 1
    base = _BASE
    grams = piece.astype(np.uint64)
    grams += np.uint64(1)
    width, four = 1, None
    while width < 16:
        grams = grams[:-width] * np.uint64(base) + grams[width:]
        base = base * base % 2**64
        width *= 2
        if width == 4:
            four = (grams, base)
    hashed = grams[: len(grams) - 4] * np.uint64(four[1])
    hashed += four[0][16 : 16 + len(hashed)]
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(32)
    # Places make neighbouring starts agree on one occurrence of a gram.
    hashed &= np.uint64(0xFFFFFFFFFFFF0000)
    hashed |= np.arange(len(hashed), dtype=np.uint64) & np.uint64(0xFFFF)
    span, width = LENGTH - GRAM + 1, 1
    least = hashed
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:count], least[span - width : span - width + count])
    here = fits[at : at + count]
    moved = np.ones(count + 1, bool)
    moved[1:-1] = least[1:] != least[:-1]
    begins = np.flatnonzero(here & (moved[:-1] | ~np.concatenate(([False], here[:-1]))))
    stops = np.flatnonzero(here & (moved[1:] | ~np.concatenate((here[1:], [False])))) + 1
    return _spread(least[begins] >> np.uint64(16)), begins + at, stops - begins


def _spread(anchors: np.ndarray) -> np.ndarray:
    """Hashes of 48 bits, one to one, as others: the least of many lie low, and shards go by range."""
    mask = np.uint64(2**48 - 1)
    anchors = anchors * np.uint64(0x9E3779B97F4B) & mask
    anchors ^= anchors >> np.uint64(24)
    return anchors * np.uint64(0xBF58476D1CE5) & mask


def _distinct(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and the place of each stretch's among them."""
    return np.unique(anchors, return_inverse=True)


def _shard_of(anchors: np.ndarray, shards: int) -> np.ndarray:
    """Shards take ranges of hashes, so that an order by hash is one by shard."""
    return (anchors.astype(np.float64) / 2.0**48 * shards).astype(np.int64)


def _cuts(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal numbers: the number, where it starts and where it stops."""
    if len(shard):
        starts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1]).tolist()
        for start, stop in zip(starts, [*starts[1:], len(shard)]):
            yield int(shard[start]), start, stop


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_PARTS)


def _send_anchors(shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                batch = _Batch(row)
                anchors, _, _, docs = batch.stretches()
                hashes, which = _distinct(anchors)
                least = np.full(len(hashes), _NO_ID)
                most = np.full(len(hashes), np.iinfo(np.int64).min)
                np.minimum.at(least, which, batch.order[docs])
                np.maximum.at(most, which, batch.order[docs])
                sent = []
                for shard, start, stop in _cuts(_shard_of(hashes, shards)):
                    part = hashes[start:stop]
                    steps = np.diff(part, prepend=np.uint64(0))
                    content = _pack(steps, (least < most)[start:stop].astype(np.uint8))
                    sent.append((shard, row["batch"], 0, content))
                yield from _messages(sent).to_batches()

    return work


def _answer_anchors(table: pa.Table) -> pa.Table:
    """To each batch, a bit for each of its hashes: whether more than one document has it."""
    rows = table.to_pylist()
    parts = [_unpack(row["content"], np.uint64, np.uint8) for row in rows]
    hashes = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in parts])
    several = np.concatenate([flags for _, flags in parts]).astype(bool)
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    equal = in_order[1:] == in_order[:-1]
    repeated = several[order]
    repeated[1:] |= equal
    repeated[:-1] |= equal
    # A flag of one batch counts for all that have the hash, which are then repeated anyhow.
    out = np.empty(len(hashes), bool)
    out[order] = repeated
    sent, at = [], 0
    for row, (steps, _) in zip(rows, parts):
        bits = np.packbits(out[at : at + len(steps)])
        sent.append((row["shard"], row["batch"], len(steps), bits.tobytes()))
        at += len(steps)
    return _messages(sent)


def _bits(messages: list[dict]) -> np.ndarray:
    """The answers to one batch, in the order of its shards."""
    answers = sorted((m for m in messages if m["shard"] != _SHARD_OF_INDEX), key=lambda m: m["shard"])
    parts = [np.unpackbits(np.frombuffer(m["content"], np.uint8), count=m["kind"]) for m in answers]
    return np.concatenate([np.empty(0, np.uint8), *parts]).astype(bool)


def _send_stretches(shards: int):
    def work(batch_rows: pa.Table, answers: pa.Table) -> pa.Table:
        sent = []
        for row in batch_rows.to_pylist():
            batch = _Batch(row)
            anchors, starts, counts, docs = batch.stretches()
            hashes, which = _distinct(anchors)
            repeated = _bits(answers.to_pylist())[which] if len(hashes) else np.empty(0, bool)
            in_text = np.flatnonzero(repeated)
            by_anchor = np.argsort(anchors[in_text], kind="stable")
            chosen = in_text[by_anchor]
            whole = batch.bytes.tobytes()
            places: dict[bytes, int] = {}
            stops = starts[chosen] + counts[chosen] + (LENGTH - 1)
            number = np.fromiter(
                (places.setdefault(whole[a:b], len(places)) for a, b in zip(starts[chosen].tolist(), stops.tolist())),
                np.int64,
                len(chosen),
            )
            least = np.full(len(places), _NO_ID)
            np.minimum.at(least, number, batch.order[docs[chosen]])
            shard = np.zeros(len(places), np.int64)
            shard[number] = _shard_of(anchors[chosen], shards)
            texts = list(places)
            for to, start, stop in _cuts(shard):
                part = texts[start:stop]
                lengths = np.array([len(text) for text in part], np.uint8)
                content = _pack(lengths, least[start:stop], np.frombuffer(b"".join(part), np.uint8))
                sent.append((to, row["batch"], 0, content))
            # The index goes by the text, where steps between stretches are small numbers.
            number_of = np.empty(len(number), np.uint32)
            number_of[by_anchor] = number
            steps = np.diff(starts[in_text], prepend=0).astype(np.uint32)
            index = _pack(steps, counts[in_text].astype(np.uint8), number_of, least)
            sent.append((_SHARD_OF_INDEX, row["batch"], 0, index))
        return _messages(sent)

    return work


def _answer_stretches(table: pa.Table) -> pa.Table:
    """To each batch, a bit for each string of its stretches: whether a smaller id has it."""
    rows = table.to_pylist()
    parts = [_unpack(row["content"], np.uint8, np.int64, np.uint8) for row in rows]
    places: dict[bytes, int] = {}
    numbers = []
    for lengths, _, data in parts:
        raw, stops = data.tobytes(), np.cumsum(lengths, dtype=np.int64)
        numbers.append(
            np.fromiter(
                (places.setdefault(raw[b - n : b], len(places)) for n, b in zip(lengths.tolist(), stops.tolist())),
                np.int64,
                len(lengths),
            )
        )
    number = np.concatenate(numbers)
    least = np.full(len(places), _NO_ID)
    np.minimum.at(least, number, np.concatenate([ids for _, ids, _ in parts]))
    text = np.frombuffer(b"".join(places), np.uint8)
    sizes = np.array([len(stretch) for stretch in places], np.int64)
    first = least_of_strings(text, sizes, least)
    # Strings per distinct stretch stand together, in the order of the stretches.
    windows = sizes - (LENGTH - 1)
    begins = np.cumsum(windows) - windows
    sent = []
    for row, own, (_, ids, _) in zip(rows, numbers, parts):
        count = windows[own]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        bits = first[np.repeat(begins[own], count) + inside] < np.repeat(ids, count)
        sent.append((row["shard"], row["batch"], len(bits), np.packbits(bits).tobytes()))
    return _messages(sent)


def least_of_strings(text: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each string of full length in the stretches of ``text``, the smallest id that has it."""
    ends = np.cumsum(sizes)
    windows = sizes - (LENGTH - 1)
    stretch = np.repeat(np.arange(len(sizes)), windows)
    inside = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = (ends - sizes)[stretch] + inside
    place = np.full(len(text), -1)
    place[starts] = np.arange(len(starts))
    order = suffix_array(text)
    order = order[place[order] >= 0]
    shared = common_prefixes(text, order, LENGTH)
    group = np.flatnonzero(shared < LENGTH)
    which = place[order]
    least = np.minimum.reduceat(ids[stretch[which]], group)
    out = np.empty(len(starts), np.int64)
    out[which] = np.repeat(least, np.diff(np.append(group, len(order))))
    return out


def _cover(batch_rows: pa.Table, messages: pa.Table) -> pa.Table:
    """The documents of a batch without what is repeated, and the spans taken out."""
    names = ["id", "n_bytes", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    out = [[], [], [], []]
    said = messages.to_pylist()
    for row in batch_rows.to_pylist():
        batch = _Batch(row)
        index = next(m["content"] for m in said if m["shard"] == _SHARD_OF_INDEX)
        steps, counts, number, least = _unpack(index, np.uint32, np.uint8, np.uint32, np.int64)
        starts = np.cumsum(steps, dtype=np.int64)
        earlier = _bits(said)
        counts = counts.astype(np.int64)
        windows = np.zeros(len(least), np.int64)
        windows[number] = counts
        begins = np.cumsum(windows) - windows
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(starts, counts) + inside
        order = batch.order[np.searchsorted(batch.ends, at, "right")]
        gone = earlier[np.repeat(begins[number], counts) + inside] | (np.repeat(least[number], counts) < order)
        edges = np.zeros(len(batch.bytes) + 1, np.int32)
        np.add.at(edges, at[gone], 1)
        np.add.at(edges, at[gone] + LENGTH, -1)
        covered = np.cumsum(edges[:-1], dtype=np.int32) > 0
        turns = covered.copy()
        turns[1:] ^= covered[:-1]
        inner = batch.ends[:-1][batch.ends[:-1] < len(covered)]
        inner = inner[inner > 0]
        # A span that ends with its document and one that starts the next are two.
        turns[inner] = False
        rises = np.zeros(len(covered) + 1, bool)
        falls = np.zeros(len(covered) + 1, bool)
        rises[:-1] = turns & covered
        falls[:-1] = turns & ~covered
        rises[inner] |= covered[inner]
        falls[inner] |= covered[inner - 1]
        if len(covered):
            falls[-1] = covered[-1]
        rise, fall = np.flatnonzero(rises), np.flatnonzero(falls)
        begin = batch.ends - batch.sizes
        low, high = np.searchsorted(rise, begin, "left"), np.searchsorted(rise, batch.ends, "left")
        for place, (a, b) in enumerate(zip(begin.tolist(), batch.ends.tolist())):
            spans = [
                {"start": s - a, "end": e - a}
                for s, e in zip(rise[low[place] : high[place]].tolist(), fall[low[place] : high[place]].tolist())
            ]
            out[0].append(None if batch.missing[place] else int(batch.ids[place]))
            out[1].append(b - a)
            out[2].append(spans)
            out[3].append(batch.bytes[a:b][~covered[a:b]].tobytes() if spans else batch.bytes[a:b].tobytes())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, the ``spans`` taken out, and the bytes ``kept``."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    batches = cut_lineage(_batched(rows, batch_bytes))
    size = batches.agg(F.sum("bytes")).first()[0] or 0
    shards = -(-size // shard_bytes) + docs.sparkSession.sparkContext.defaultParallelism
    anchors = batches.mapInArrow(_send_anchors(shards), _MESSAGES)
    answers = cut_lineage(anchors.groupBy("shard").applyInArrow(_answer_anchors, _MESSAGES))
    by_batch = batches.groupBy("batch")
    sent = cut_lineage(
        by_batch.cogroup(answers.groupBy("batch")).applyInArrow(_send_stretches(shards), _MESSAGES)
    )
    index = sent.where(F.col("shard") == _SHARD_OF_INDEX)
    found = sent.where(F.col("shard") != _SHARD_OF_INDEX).groupBy("shard").applyInArrow(_answer_stretches, _MESSAGES)
    replies = cut_lineage(found).unionByName(index)
    shape = "id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"
    done = by_batch.cogroup(replies.groupBy("batch")).applyInArrow(_cover, shape)
    return done.withColumnRenamed("id", id_col)


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(load(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
