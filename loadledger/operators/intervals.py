"""Windows of any length as rows: what lies in them, what they cover, and the newest row before an instant.

Windows are half-open, ``start <= t < end``. One with a null end or without length holds nothing.
A null key is a key like any other for coverage, and joins nothing, as in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.operators.running import running, running_sums
from loadledger.work import cut_lineage


def _micros(moment: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)


def _windows(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(start) < F.col(end))


def in_windows(
    rows: DataFrame, ts: str, windows: DataFrame, keys: Sequence[str] = (), start: str = "window_start", end: str = "window_end"
) -> DataFrame:
    """Every row with every window of its key that holds it; columns of both, keys once.

    Time is cut into bins as wide as a window, to the next power of two. A window goes into the one or
    two bins it touches, and a row into one bin for each width that occurs among the windows; both
    meet by equality of key, width and bin, and the instants are compared there. So long windows
    among short ones cost each row one more bin, and no pair meets twice. It is an equi-join to Spark,
    which can split a hot key.

    ``rows`` and ``windows`` share no column but the keys.
    """
    length = _micros(F.col(end)) - _micros(F.col(start))
    # The bits of a length tell its class; lengths of a class differ by less than a factor of two.
    power = F.length(F.bin(length - 1))
    windows = _windows(windows, start, end).withColumn("_power", F.when(length == 1, 0).otherwise(power))
    # There are at most 64 classes, whatever the number of windows.
    powers = sorted(row[0] for row in windows.select("_power").distinct().collect()) or [0]
    touched = windows.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_power")), _last_bin(end))))
    bins = F.array(*[F.struct(F.lit(p).alias("_power"), _bin(F.col(ts), F.lit(p)).alias("_bin")) for p in powers])
    placed = rows.select("*", F.inline(bins))
    inside = (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))
    return placed.join(touched, [*keys, "_power", "_bin"]).where(inside).drop("_power", "_bin")


def _bin(moment: Column, power: Column) -> Column:
    """The bin of an instant: shifting rounds down, also before 1970."""
    return F.call_function("shiftright", _micros(moment), power.cast("int"))


def _last_bin(end: str) -> Column:
    return F.call_function("shiftright", _micros(F.col(end)) - 1, F.col("_power").cast("int"))


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_on: str, right_on: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Each row of ``left`` with the newest row of ``right`` of its key at or before its instant.

    Of rows of ``right`` at one instant the last by ``ties`` counts. Rows of ``left`` without a match or
    an instant have nulls. The sides share no column but the keys. Both are laid in one order by key
    and time, where the newest version runs along; a hot key spreads over many slices.
    """
    others = [name for name in right.columns if name not in keys]
    of_left = F.struct(*[F.col(name).alias(f"l{k}") for k, name in enumerate(left.columns)])
    of_right = F.struct(*[F.col(name).alias(f"r{k}") for k, name in enumerate(others)])
    named = {key: f"_k{k}" for k, key in enumerate(keys)}
    numbered = {name: f"_t{k}" for k, name in enumerate(ties)}
    mine = left.select(
        *[F.col(key).alias(to) for key, to in named.items()],
        F.col(left_on).alias("_at"),
        F.lit(1).alias("_side"),
        *[F.lit(None).cast(right.schema[name].dataType).alias(to) for name, to in numbered.items()],
        of_left.alias("_left"),
        F.lit(None).alias("_right"),
    )
    theirs = right.where(F.col(right_on).isNotNull()).select(
        *[F.col(key).alias(to) for key, to in named.items()],
        F.col(right_on).alias("_at"),
        F.lit(0).alias("_side"),
        *[F.col(name).alias(to) for name, to in numbered.items()],
        F.lit(None).alias("_left"),
        of_right.alias("_right"),
    )
    both = theirs.unionByName(mine)
    order = ["_at", "_side", *numbered.values()]
    carried = running(both, list(named.values()), order, {"_right": "last"})
    found = carried.where("_left IS NOT NULL")
    known = F.col("_at").isNotNull()
    for to in named.values():
        known = known & F.col(to).isNotNull()
    return found.select(
        *[F.col(f"_left.l{k}").alias(name) for k, name in enumerate(left.columns)],
        *[F.when(known, F.col(f"_right.r{k}")).alias(name) for k, name in enumerate(others)],
    )


def islands(windows: DataFrame, keys: Sequence[str], start: str = "window_start", end: str = "window_end") -> DataFrame:
    """What the windows of each key cover together: keys and ranges that neither overlap nor touch."""
    rows = _windows(windows, start, end).select(*keys, start, end).distinct()
    rows = rows.withColumn("_reach", F.col(end))
    reached = running(rows, keys, [start, end], {"_reach": "max"}, before=True)
    opens = F.col("_reach").isNull() | (F.col(start) > F.col("_reach"))
    marked = reached.withColumn("_island", opens.cast("bigint")).drop("_reach")
    numbered = running_sums(marked, keys, [start, end], ["_island"])
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def uncovered(
    wanted: DataFrame, covered: DataFrame, keys: Sequence[str], start: str = "window_start", end: str = "window_end"
) -> DataFrame:
    """The ranges that are wanted and that no window covers, per key, as long as they can be.

    Begins and ends of both sides are laid in order of time; how many windows of each side are open
    runs along. A key without wanted ranges has none.
    """

    def steps(windows: DataFrame, side: str) -> list[DataFrame]:
        counted = [(start, 1), (end, -1)]
        other = "_covered" if side == "_wanted" else "_wanted"
        return [
            _windows(windows, start, end).select(
                *keys, F.col(at).alias("_at"), F.lit(by).cast("bigint").alias(side), F.lit(0).cast("bigint").alias(other)
            )
            for at, by in counted
        ]

    listed = [*steps(wanted, "_wanted"), *steps(covered, "_covered")]
    every = listed[0]
    for more in listed[1:]:
        every = every.unionByName(more)
    # One row per key and instant: a partial aggregate, so a hot key is small before it is dealt out.
    at = cut_lineage(every.groupBy(*keys, "_at").agg(F.sum("_wanted").alias("_wanted"), F.sum("_covered").alias("_covered")))
    open_before = running(
        at.withColumn("_from", F.col("_at")), keys, ["_at"], {"_wanted": "sum", "_covered": "sum", "_from": "max"}, before=True
    )
    gaps = open_before.where("_wanted > 0 AND _covered = 0 AND _from IS NOT NULL")
    return islands(gaps.select(*keys, F.col("_from").alias(start), F.col("_at").alias(end)), keys, start, end)


def outside_all(
    rows: DataFrame, ts: str, windows: DataFrame, keys: Sequence[str], start: str = "window_start", end: str = "window_end"
) -> DataFrame:
    """The rows that no window of their key holds; rows without an instant are not among them.

    Windows are first merged to what they cover together, so the last one that starts at or before a
    row is the only one that can hold it.
    """
    covered = islands(windows, keys, start, end)
    found = asof_join(rows.where(F.col(ts).isNotNull()), covered, keys, ts, start)
    return found.where(F.col(end).isNull() | (F.col(ts) >= F.col(end))).drop(start, end)
