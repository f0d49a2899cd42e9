"""The prefix trie of conversations, from whole sequences.

A conversation is a sequence of turns. Its first d turns are named by d and the sum of their hashes,
each taken with its place; that sum is the same wherever the same turns stand at the same places, and
running sums of one long conversation can be split over tasks, which a chain of hashes cannot.

Identical conversations collapse first: each distinct sequence keeps its weight, its smallest
conversation and a digest of its list of ends. Sequences that are proper prefixes of others are told
from leaves by an anti-join. From there on only one conversation of each distinct sequence is looked
at: its prefixes, with its weight, are aggregated into nodes. What a subtree adds up to is summed from
the ends of the sequences through its top, so no pair of node and ancestor is ever listed.

Defined results: rows without a conversation belong to none. A null role or text counts as empty, a
null turn comes first, and rows of one turn go in the order of a digest of role and text; equal rows are
turns of their own. An empty table gives no node, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loadledger.llm.registry import load, query
from loadledger.operators.running import number_rows, running_sums
from loadledger.work import cut_lineage

#: Conversations are spliced with the first one of their hundred, after fewer turns than ``CUTS``.
EVERY = 100
CUTS = 6
#: Ends that are written into one piece of a list.
PIECE = 10_000
_LANES = [f"_lane{k}" for k in range(8)]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1 on, a ``digest`` of role and text, and ``chars``, the text's code points."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars")
    )
    return number_rows(rows, ["conv_id"], ["turn", "digest"], "place").drop("turn")


def spliced(turns: DataFrame, every: int = EVERY, cuts: int = CUTS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and all conversations, also those that end up without a turn.

    Conversation c starts with the first h turns of c - c % every and goes on with its own after its
    first h, where h is the CRC-32 of c in decimal, modulo ``cuts``.
    """
    convs = cut_lineage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    cut = F.crc32(F.col("conv_id").cast("string")) % cuts
    heads = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), cut.alias("h"))
    bases = convs.select(F.col("conv_id").alias("_base"), F.col("n").alias("base_n"))
    heads = cut_lineage(
        heads.join(bases, F.col("base") == F.col("_base"), "left").select(
            F.col("conv_id").alias("conv"), "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("given")
        )
    )
    first = turns.where(F.col("place") < cuts).join(heads, F.col("conv_id") == F.col("base")).where("place <= h")
    own = turns.join(heads, F.col("conv_id") == F.col("conv")).where("place > h")
    rebuilt = first.select("conv", "place", "digest", "chars").unionByName(
        own.select("conv", (F.col("given") + F.col("place") - F.col("h")).alias("place"), "digest", "chars")
    )
    return rebuilt.withColumnRenamed("conv", "conv_id"), convs.select("conv_id")


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", depth.cast("string"), *[lane.cast("string") for lane in lanes]), 256))


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0)] * len(_LANES))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Every conversation's prefixes: ``depth``, ``key``, ``parent``, the last turn's ``chars`` and ``until``, all so far."""
    hashed = turns.withColumn("_hash", F.sha2(F.concat_ws(":", F.col("place").cast("string"), "digest"), 256))
    # 32 bits a lane: their sums stay exact for any number of turns below two billion.
    lanes = {lane: F.conv(F.substring("_hash", 1 + 8 * k, 8), 16, 10).cast("long") for k, lane in enumerate(_LANES)}
    rows = hashed.withColumns(lanes).select("conv_id", "place", "chars", F.array(*_LANES).alias("own"), *_LANES,
                                            F.col("chars").alias("until"))
    sums = running_sums(rows, ["conv_id"], ["place"], [*_LANES, "until"])
    before = [F.col(lane) - F.col("own")[k] for k, lane in enumerate(_LANES)]
    return cut_lineage(
        sums.select(
            "conv_id",
            F.col("place").alias("depth"),
            _key(F.col("place"), [F.col(lane) for lane in _LANES]).alias("key"),
            _key(F.col("place") - 1, before).alias("parent"),
            "chars",
            "until",
        )
    )


def ends_digests(members: DataFrame, piece: int = PIECE) -> DataFrame:
    """``key`` and ``ends_sha256``: of each sequence the digest of its conversations in order, comma-joined.

    A list that is too long for a task is written in pieces by many. A digest has to see a list from
    its start to its end, so the pieces of one list pass through one task, one batch at a time.
    """
    numbered = number_rows(members.select("key", "conv_id"), ["key"], ["conv_id"], "_n")
    part = F.floor((F.col("_n") - 1) / piece).alias("_part")
    listed = F.array_sort(F.collect_list("conv_id")).cast("array<string>")
    pieces = numbered.groupBy("key", part).agg(F.concat_ws(",", listed).alias("ends"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for now, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is not None and now == key:
                    digest.update(b"," + ends.encode())
                    continue
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(ends.encode())
            yield made(done)
        if digest is not None:
            yield made([(key, digest.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([k for k, _ in done], key_type), pa.array([d for _, d in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["key", "ends_sha256"])

    key_type = to_arrow_type(members.schema["key"].dataType)
    in_order = pieces.repartition("key").sortWithinPartitions("key", "_part").select("key", "ends")
    return in_order.mapInArrow(work, "key binary, ends_sha256 string")


def sequences(prefixes: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct whole sequences, and the conversations of each.

    Of a sequence: ``key``, ``first``, its smallest conversation, ``weight``, how many it has, ``n``
    turns and ``total`` code points.
    """
    tops = prefixes.groupBy("conv_id").agg(
        F.max_by("key", "depth").alias("_key"), F.max("depth").alias("_n"), F.max("until").alias("_total")
    )
    members = cut_lineage(
        convs.join(tops, "conv_id", "left").select(
            "conv_id",
            F.coalesce("_key", _root()).alias("key"),
            F.coalesce("_n", F.lit(0)).cast("long").alias("n"),
            F.coalesce("_total", F.lit(0)).cast("long").alias("total"),
        )
    )
    whole = members.groupBy("key").agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("weight"), F.max("n").alias("n"), F.max("total").alias("total")
    )
    return cut_lineage(whole), members


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id``, ``place``, ``digest``, ``chars``).

    ``convs`` has each conversation once, as ``conv_id``; one without turns ends at the root.
    """
    prefixes = _prefixes(turns)
    whole, members = sequences(prefixes, convs)
    firsts = whole.select(F.col("first"), "weight", "n", "total")
    kept = prefixes.join(firsts, F.col("conv_id") == F.col("first")).drop("conv_id")
    kept = cut_lineage(
        kept.unionByName(
            firsts.select(
                F.lit(0).cast("long").alias("depth"), _root().alias("key"), F.lit(None).cast("binary").alias("parent"),
                F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("until"), "first", "weight", "n", "total",
            )
        )
    )
    proper = kept.where("depth < n").select("key").distinct()
    leaves = cut_lineage(whole.join(proper, "key", "left_anti").select(F.col("first").alias("_leaf")))
    counted = kept.join(leaves, F.col("first") == F.col("_leaf"), "left")
    nodes = cut_lineage(
        counted.groupBy("key").agg(
            F.min("first").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("parent").alias("parent"),
            F.sum("weight").alias("n_convs"),
            F.count("_leaf").alias("n_leaves"),
        )
    )
    # A node's turn is counted once in a subtree: with the sequence of its smallest conversation. A
    # sequence owns its nodes from some depth on, so what it owns is a stretch up to its end.
    after = F.col("total") - F.col("until") + F.col("chars")
    owners = nodes.select(F.col("key").alias("_key"), F.col("conv_id").alias("_owner"))
    owned = kept.join(owners, (F.col("key") == F.col("_key")) & (F.col("first") == F.col("_owner")))
    owned = cut_lineage(owned.groupBy(F.col("first").alias("_first")).agg(F.max(after).alias("_owned")))
    stretch = F.col("weight") * after - F.least(after, F.coalesce("_owned", F.lit(0)))
    saved = kept.join(owned, F.col("first") == F.col("_first"), "left").groupBy(F.col("key").alias("_key")).agg(
        F.sum(stretch).alias("saved_tokens")
    )
    children = nodes.groupBy(F.col("parent").alias("_parent")).agg(F.count(F.lit(1)).alias("_children"))
    above = nodes.select(F.col("key").alias("_above"), F.col("conv_id").alias("parent_conv_id"))
    ends = ends_digests(members).withColumnRenamed("key", "_end")
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(saved, F.col("key") == F.col("_key"))
        .join(children, F.col("key") == F.col("_parent"), "left")
        .join(ends, F.col("key") == F.col("_end"), "left")
        .join(above, F.col("parent") == F.col("_above"), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


def node_turns(nodes: DataFrame, conversations: DataFrame, every: int = EVERY, cuts: int = CUTS) -> DataFrame:
    """``nodes`` with the ``role`` and ``text`` of each node's last turn; null at the root.

    A node's turn is read from its smallest conversation, or from the one that was spliced before it.
    """
    turns = numbered_turns(conversations)
    rebuilt, _ = spliced(turns, every, cuts)
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    known = conversations.select(
        F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256).alias("_digest"), role.alias("role"), text.alias("text")
    )
    at = rebuilt.select(F.col("conv_id").alias("_conv"), F.col("place").alias("_place"), F.col("digest"))
    named = nodes.join(at, (F.col("conv_id") == F.col("_conv")) & (F.col("depth") == F.col("_place")), "left")
    wanted = cut_lineage(named.drop("_conv", "_place"))
    texts = known.join(wanted.select(F.col("digest").alias("_digest")).distinct(), "_digest", "left_semi").dropDuplicates(["_digest"])
    return wanted.join(texts, F.col("digest") == F.col("_digest"), "left").drop("digest", "_digest")


@query(
    sql="""
WITH given AS (
  SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT conv_id, said, chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(said)) AS place
  FROM given
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM numbered GROUP BY conv_id
), heads AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS given FROM convs AS c LEFT JOIN convs AS b ON b.conv_id = c.base
), rebuilt AS (
  SELECT h.conv_id, n.place, n.said, n.chars FROM heads AS h JOIN numbered AS n ON n.conv_id = h.base AND n.place <= h.h
  UNION ALL
  SELECT h.conv_id, h.given + n.place - h.h, n.said, n.chars
  FROM heads AS h JOIN numbered AS n ON n.conv_id = h.conv_id AND n.place > h.h
), keyed AS (
  SELECT conv_id, place AS depth, chars,
         sha256(string_agg(sha256(said), ',') OVER (PARTITION BY conv_id ORDER BY place)) AS key
  FROM rebuilt
), prefixes AS (
  SELECT conv_id, depth, chars, key, lag(key, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM keyed
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM convs
), nodes AS (
  SELECT key, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth,
         any_value(chars) AS chars, count(*) AS n_convs
  FROM prefixes GROUP BY key
), lengths AS (
  SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id
), ends AS (
  SELECT p.key, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS ends_sha256
  FROM prefixes AS p JOIN lengths USING (conv_id, depth) GROUP BY p.key
), children AS (
  SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT a.key, count(*) FILTER (c.parent IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM nodes AS n LEFT JOIN children AS c ON c.parent = n.key
  JOIN prefixes AS a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.key
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes AS n JOIN below AS b USING (key) LEFT JOIN ends AS e USING (key)
LEFT JOIN children AS c ON c.parent = n.key LEFT JOIN nodes AS u ON u.key = n.parent
"""
)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = numbered_turns(load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie(*spliced(turns))
