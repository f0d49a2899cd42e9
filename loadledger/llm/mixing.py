"""Mixing sources to target weights by balanced sampling (the cube method).

Each source has a target in words, up to ``MOST`` times what it holds, so each of its documents is
taken ``target / size of the source`` times on average. The whole part of that is the same for all;
the fraction is an inclusion probability, and the cube method turns these into a sample. In the
flight phase, probabilities move along directions that change neither the sum of the probabilities
nor the sum of the words they stand for, until at most two of them are left undecided. Strata are a
source and a class of sizes within a factor of two; large strata fly in blocks of bounded size, whose
undecided rows fly again together. Only the landing problem remains: a few documents per source, at
most two of each size class, which are settled from the largest down so that the words come out
nearest to the target.

Everything random is a hash of the id, then of the text, so reruns agree. Rows are moved without their texts.

Defined results: a null text has size 0; such documents need no draw. A null source is a source of
its own and comes last. A null id is hashed like any other; repeated rows are drawn each for itself. In :func:`taken_rows`
rows equal in id, source and text stand for each other.
Sources without words have target 0. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import load, query
from loadledger.llm.rows import digest, orderable
from loadledger.operators.running import number_rows
from loadledger.work import cut_lineage

#: No document is taken more often than this, and no target is above this many times its source.
MOST = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Rows that fly together in one task, about.
BLOCK = 1_000
#: Probabilities this near to 0 or 1 are decided.
_NEAR = 1e-9
#: Landing sums are told apart to this many steps.
_STEPS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with the ``target`` of each source.

    All sources share one level, words per unit of weight. What lies above a source's limit raises
    the level of the others, until no other is above its own. Each round is one aggregate.
    """
    placed = sizes.select(
        F.lit(0).alias("_all"), F.col("source").isNull().alias("_none"), "source", "source_size"
    )
    numbered = number_rows(placed, ["_all"], ["_none", "source"], "_place")
    listed = F.array(*[F.lit(weight) for weight in weights])
    weight = F.get(listed, ((F.col("_place") - 1) % len(weights)).cast("int"))
    rows = cut_lineage(numbered.select("source", "source_size", weight.cast("decimal(38,0)").alias("_weight")))
    limit = F.col("source_size").cast("decimal(38,0)") * most
    words, total = rows.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.sum("_weight")).first()
    rest, share = words or 0, total or 0
    while True:
        over = limit * F.lit(share) < F.col("_weight") * F.lit(rest)
        taken, weighed = rows.where(over).agg(F.sum(limit), F.sum("_weight")).first()
        now = ((words or 0) - (taken or 0), (total or 0) - (weighed or 0))
        if now == (rest, share):
            break
        rest, share = now
    level = F.col("_weight").cast("double") * F.lit(float(rest)) / F.lit(float(share or 1))
    return rows.select("source", "source_size", F.when(over, limit.cast("double")).otherwise(level).alias("target"))


def fly(sizes: list[int], chances: list[float], draw: random.Random) -> list[float]:
    """Move chances along the null space of counts and words until at most two are undecided.

    Three undecided rows at a time leave one direction that changes neither sum. The step goes as
    far as a chance of 0 or 1 on either side, and the side is drawn so that no chance is biased.
    """
    out = list(chances)
    waiting = iter([k for k, chance in enumerate(out) if _NEAR < chance < 1 - _NEAR])
    active: list[int] = []
    while True:
        while len(active) < 3 and (k := next(waiting, None)) is not None:
            active.append(k)
        x = [sizes[k] for k in active]
        if len(active) == 3 and len(set(x)) > 1:
            along = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
        elif len(active) == 3 or len(active) == 2 and x[0] == x[1]:
            along = [1, -1, 0]
        else:
            return out
        moves = [(k, u) for k, u in zip(active, along) if u]
        ahead = min((1 - out[k]) / u if u > 0 else out[k] / -u for k, u in moves)
        back = min(out[k] / u if u > 0 else (1 - out[k]) / -u for k, u in moves)
        step = ahead if draw.random() * (ahead + back) < back else -back
        for k, u in moves:
            chance = out[k] + step * u
            out[k] = 0.0 if chance <= _NEAR else 1.0 if chance >= 1 - _NEAR else chance
        active = [k for k in active if 0 < out[k] < 1]


def land(sizes: list[int], chances: list[float]) -> list[float]:
    """Settle the last undecided rows so that their words come nearest to what they stood for."""
    left = [k for k, chance in enumerate(chances) if 0 < chance < 1]
    out = list(chances)
    if not left:
        return out
    unit = max(1.0, sum(sizes[k] for k in left) / _STEPS)
    steps = [round(sizes[k] / unit) for k in left]
    wanted = round(sum(sizes[k] * chances[k] for k in left) / unit)
    reached = [1]
    for step in steps:
        reached.append(reached[-1] | reached[-1] << step)
    sums = reached[-1]
    below = (sums & (1 << wanted + 1) - 1).bit_length() - 1
    above = sums >> wanted + 1
    over = wanted + 1 + ((above & -above).bit_length() - 1) if above else None
    at = over if over is not None and over - wanted < wanted - below else below
    for place in range(len(left) - 1, -1, -1):
        skipped = reached[place] >> at & 1
        out[left[place]] = 0.0 if skipped else 1.0
        at -= 0 if skipped else steps[place]
    return out


def _order(rows: pa.Table, key: Callable[[dict], tuple]) -> list[int]:
    named = rows.select(["id", "size", "hash", "digest"]).to_pylist()
    return sorted(range(len(named)), key=lambda place: key(named[place]))


def _settled(rows: pa.Table, order: list[int], settle: Callable) -> pa.Table:
    """``rows`` with the chances that ``settle`` gives when it sees them in ``order``."""
    sizes, chances = rows["size"].to_pylist(), rows["chance"].to_pylist()
    made = settle([sizes[k] for k in order], [chances[k] for k in order])
    for place, chance in zip(order, made):
        chances[place] = chance
    column = rows.schema.get_field_index("chance")
    return rows.set_column(column, "chance", pa.array(chances, pa.float64()))


def _decided() -> Column:
    return (F.col("chance") == 0) | (F.col("chance") == 1)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, source, size, its source's size and target, ``copies``, ``taken``."""
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            digest(F.col(text_col)).alias("digest"),
        )
    )
    strata = cut_lineage(
        rows.groupBy("source", F.floor(F.log2("size")).alias("class")).agg(F.sum("size").alias("words"))
    )
    aims = targets(strata.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    aims = aims.withColumnRenamed("source", "_source")
    known = cut_lineage(
        strata.join(aims, F.col("source").eqNullSafe(F.col("_source"))).select(
            "_source", F.col("class").alias("_class"), "source_size", "target"
        )
    )
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = times - F.floor(times + _NEAR)
    here = rows.withColumn("class", F.floor(F.log2("size"))).join(
        known, F.col("source").eqNullSafe(F.col("_source")) & F.col("class").eqNullSafe(F.col("_class"))
    )
    aimed = cut_lineage(
        here.select(
            "id",
            "source",
            "size",
            "digest",
            "source_size",
            "target",
            "class",
            F.floor(times + _NEAR).cast("long").alias("whole"),
            F.when((part > _NEAR) & (F.col("size") > 0), part).otherwise(F.lit(0.0)).alias("chance"),
            F.xxhash64("id").alias("hash"),
        )
    )
    settled = [aimed.where(_decided())]
    flying = aimed.where(~_decided())
    shape = aimed.schema

    def flown(key: tuple, rows: pa.Table) -> pa.Table:
        order = _order(rows, lambda row: (row["hash"], row["size"], repr(row["id"]), row["digest"]))
        draw = random.Random(zlib.crc32(repr([part.as_py() for part in key]).encode()))
        return _settled(rows, order, lambda sizes, chances: fly(sizes, chances, draw))

    def landed(rows: pa.Table) -> pa.Table:
        order = _order(rows, lambda row: (-row["size"], row["hash"], repr(row["id"]), row["digest"]))
        return _settled(rows, order, land)

    while True:
        # Blocks are cut by number, as ids may be null or repeated, and are of even size.
        numbered = number_rows(flying, ["source", "class"], ["hash", "size", "digest"], "_block")
        dealt = cut_lineage(numbered.withColumn("_block", F.floor((F.col("_block") - 1) / block)))
        last = not (dealt.agg(F.max("_block")).first()[0] or 0)
        flights = dealt.groupBy("source", "class", "_block").applyInArrow(flown, dealt.schema)
        after = cut_lineage(flights.drop("_block"))
        settled.append(after.where(_decided()))
        flying = after.where(~_decided())
        if last:
            break
    settled.append(cut_lineage(flying.groupBy("source").applyInArrow(landed, shape)))
    everything = settled[0]
    for part_of in settled[1:]:
        everything = everything.unionByName(part_of.select(*shape.names))
    copies = F.col("whole") + F.col("chance").cast("long")
    return everything.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        F.col("digest").alias("text_sha256"),
    )


def taken_rows(docs: DataFrame, drawn: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that ``drawn``, its mix, takes, with ``copies``.

    Rows are found by id, source and text. Where several are equal in these, they give way to the one
    that is smallest by all columns that have an order, once for each time that one of them was drawn.
    """
    key = ["_id", "_source", "_digest"]
    named = drawn.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col("text_sha256").alias("_digest"), "copies"
    )
    counted = named.groupBy(*key, "copies").agg(F.count(F.lit(1)).alias("_times"))
    alike = named.groupBy(*key).agg(F.count(F.lit(1)).alias("_alike"), F.max("copies").alias("copies"))
    alike = cut_lineage(alike.where("copies > 0"))
    same = (
        docs[id_col].eqNullSafe(F.col("_id"))
        & docs[source_col].eqNullSafe(F.col("_source"))
        & (digest(docs[text_col]) == F.col("_digest"))
    )
    columns = [docs[c] for c in docs.columns if c != "copies"]
    # The same join at every size: below the broadcast threshold Spark would otherwise take another.
    one = docs.join(alike.where("_alike = 1").hint("merge"), same).select(*columns, alike["copies"])
    many = alike.where("_alike > 1").drop("copies")
    if many.isEmpty():
        return one
    row = F.struct(*columns)
    order = F.struct(*[docs[f.name] for f in docs.schema if f.name != "copies" and orderable(f.dataType)])
    first = docs.join(many, same).groupBy(*key).agg(F.min_by(row, order).alias("_row"))
    counted = counted.select(*[F.col(k).alias(f"{k}2") for k in key], "copies", "_times").where("copies > 0")
    again = F.lit(True)
    for k in key:
        again = again & F.col(k).eqNullSafe(F.col(f"{k}2"))
    repeated = first.join(counted, again).withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return one.unionByName(repeated.select("_row.*", "copies"))


@query()
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(load(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
