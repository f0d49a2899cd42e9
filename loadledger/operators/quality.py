"""Checks on data and on stored runs: rules, drift, manifests, integrity, window conformance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadledger.functions.hashing import fingerprint, hash_sum
from loadledger.functions.windows import in_window
from loadledger.sources.runs import list_files


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """The names of the rules a row breaks. A rule is a condition that holds for a bad row."""
    return F.array_compact(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    )


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per broken rule."""
    return df.select(*keys, F.explode(broken_rules(rules)).alias("violation"))


def judged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows with the rules they break, and ``is_valid`` where there is none: one pass."""
    return df.withColumn("violations", broken_rules(rules)).withColumn("is_valid", F.size("violations") == 0)


def quarantine(df: DataFrame, rules: Mapping[str, Column], path: str) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the rules they break.

    The judged rows are written once, by ``is_valid``, and both frames read their folder of it.
    """
    marked = judged(df, rules)
    marked.write.partitionBy("is_valid").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    good = stored.where(F.col("is_valid")).drop("violations", "is_valid")
    return good, stored.where(~F.col("is_valid")).drop("is_valid")


def schema_rows(runs: DataFrame) -> DataFrame:
    """The columns of each stored run, from its ``schema_json``: table, run number, run, column, type.

    ``runs`` has ``table_key``, ``run_id``, ``schema_json``, ``event_ts`` and ``seq``. Runs are
    numbered per table by time; a table has few of them next to its rows.
    """
    field = "STRUCT<name: STRING, type: STRING>"
    parsed = F.from_json("schema_json", f"STRUCT<fields: ARRAY<{field}>>")["fields"]
    order = Window.partitionBy("table_key").orderBy("event_ts", "seq")
    numbered = runs.where(F.col("schema_json").isNotNull()).withColumn("run_no", F.row_number().over(order))
    return numbered.select(
        F.col("table_key").alias("table_name"), "run_no", "run_id", F.explode(parsed).alias("f")
    ).select("table_name", "run_no", "run_id", F.col("f.name").alias("column"), F.col("f.type").alias("type"))


def schema_drift(rows: DataFrame) -> DataFrame:
    """What changed between each run of a table and the run before it.

    Added and removed columns are allowed; ``is_error`` marks a changed type.
    """
    new = rows.select("table_name", "run_no", "column", F.col("type").alias("new_type"))
    runs = rows.select("table_name", "run_no").distinct()
    old = rows.select(
        "table_name", (F.col("run_no") + 1).alias("run_no"), "column", F.col("type").alias("old_type")
    )
    runs = runs.where("run_no > 1")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
        .otherwise("same")
    )
    return (
        new.join(old, ["table_name", "run_no", "column"], "full")
        .join(runs, ["table_name", "run_no"], "left_semi")
        .withColumn("change", change)
        .withColumn("is_error", F.col("change") == "type_changed")
    )


def file_manifest(
    spark: SparkSession, root: str, run_pattern: str, schema: StructType | None = None
) -> DataFrame:
    """Files, bytes and a digest per run below ``root``; ``run_pattern`` finds the run in a path.

    The digest adds up hashes of path within the run and size, so files may come in any order, no run
    has to fit in a task and no file is opened. Give ``schema`` to have the rows read as well, in
    splits: ``records`` and ``fingerprint`` are then those of the rows.
    """
    path = F.col("path")
    files = list_files(spark, root, "*.parquet").select(
        F.regexp_extract(path, run_pattern, 0).alias("run"),
        F.regexp_extract(path, f"(?:{run_pattern})/(.*)$", 1).alias("file"),
        "length",
    )
    found = (
        files.where("run <> ''")
        .groupBy("run")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
            fingerprint(["file", "length"]).alias("digest"),
        )
    )
    if schema is None:
        return found
    return found.join(run_contents(spark, root, schema, run_pattern), "run", "left")


def changed_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Runs of either manifest, and whether they differ in files, sizes or digest."""
    parts = ("n_files", "n_bytes", "digest")
    old = before.select("run", F.struct(*parts).alias("was"))
    new = after.select("run", F.struct(*parts).alias("now"))
    return old.join(new, "run", "full").select("run", (~F.col("was").eqNullSafe(F.col("now"))).alias("changed"))


def run_contents(
    spark: SparkSession, path: str | list[str], schema: StructType, run_pattern: str
) -> DataFrame:
    """Records and fingerprint per stored run, from its rows.

    Files are read in splits and summed up per file first, so size and number of runs do not matter,
    and the run is looked for in each path once. It agrees with what ``write_run`` saw go by.
    """
    found = [path] if isinstance(path, str) else path
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*found)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("records"), hash_sum(schema).alias("hashes")
    )
    return per_file.groupBy(F.regexp_extract("path", run_pattern, 0).alias("run")).agg(
        F.sum("records").alias("records"), F.sum("hashes").cast("string").alias("fingerprint")
    )


def changed_types(old: StructType, new: StructType) -> list[str]:
    """What differs in the types of columns both schemas have. Added and removed columns are fine."""
    before = {field.name: field.dataType.simpleString() for field in old}
    return [
        f"column {field.name} changed from {before[field.name]} to {field.dataType.simpleString()}"
        for field in new
        if before.get(field.name, field.dataType.simpleString()) != field.dataType.simpleString()
    ]


#: Share by which the bytes of an output may differ from what was recorded.
BYTES_TOLERANCE = 0.05


def verdict(
    recorded: Column,
    actual: Column,
    recorded_hash: Column | None = None,
    actual_hash: Column | None = None,
    tolerance: float = 0.0,
) -> Column:
    """What a stored output is worth next to what the ledger recorded about it.

    ``actual`` is NULL when there is no output. Rows must agree; for bytes, which depend on how files
    were cut, give :data:`BYTES_TOLERANCE`. Hashes are compared when both are known.
    """
    off = F.abs(actual - recorded) > recorded * tolerance
    # Where nothing was recorded, files have bytes all the same.
    if tolerance:
        off = off & (recorded > 0)
    changed = F.lit(False)
    # A recorded amount that is not known asks only that there is an output.
    if recorded_hash is not None and actual_hash is not None:
        changed = F.coalesce(recorded_hash != actual_hash, F.lit(False))
    return (
        F.when(actual.isNull(), "missing")
        .when((recorded > 0) & (actual == 0), "no_data")
        .when(off, "size_off")
        .when(changed, "content_changed")
        .otherwise("valid")
    )


def outside_window(
    df: DataFrame, keys: Sequence[str], ts: Column, start: Column, end: Column, weight: Column
) -> DataFrame:
    """Rows checked and rows outside their window, per key. Rows without a date are not checked."""
    counted = F.when(ts.isNotNull(), weight)
    missed = F.when(~in_window(ts, start, end), weight)
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(counted), F.lit(0)).alias("n_checked"),
        F.coalesce(F.sum(missed), F.lit(0)).alias("n_outside"),
    )


def outside_rows(df: DataFrame, ts: Column, start: Column, end: Column) -> DataFrame:
    """The rows outside their window, each with its window. Rows without a date are not among them."""
    return df.where(~in_window(ts, start, end)).withColumns({"window_start": start, "window_end": end})


def window_report(
    df: DataFrame, keys: Sequence[str], ts: Column, start: Column, end: Column, weight: Column
) -> DataFrame:
    """:func:`outside_window` with a verdict: ``is_consistent`` where nothing lies outside."""
    counted = outside_window(df, keys, ts, start, end, weight)
    return counted.withColumn("is_consistent", F.col("n_outside") == 0)


def unreadable_files(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Files below ``root`` from which not one row could be read.

    All files are read in one job that steps over broken ones, and the files seen are taken from the
    files listed. A sound file without rows shows up here too; the ledger knows it as a run of 0.
    """
    listed = list_files(spark, root).select("path")
    seen = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .parquet(root)
        .select(F.col("_metadata.file_path").alias("path"))
        .distinct()
    )
    return listed.join(seen, "path", "left_anti")
