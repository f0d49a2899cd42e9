"""Secret scans over histories of texts, with a ledger of the blobs already scanned.

Every version of every path is addressed by the SHA-256 of its content. The ledger, two Parquet
tables, says which pairs of blob and rule version have been scanned and what was found. A scan reads
the text of one representative per blob that still lacks a pair, and of no other; findings are then
joined to all paths that ever held the blob. A new rule version makes only its own pairs pending.

Everything is built-in functions: a rule's matches come from ``regexp_extract_all`` and the gaps
between them from ``split`` by the same pattern, so the offsets are running sums of their lengths.

Defined results: null text is the empty blob; a null path is a path like any other; repeated rows
each get their findings; an empty table gives an empty result. Offsets are code points, ends
exclusive. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadledger.llm.registry import load, query
from loadledger.work import cut_lineage, exists, new_dir

_SCANNED = "blob string, kind string, version int"
_FINDINGS = "blob string, kind string, version int, start long, end long"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost matches count if ``group`` has at least ``least`` code points."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


# The base rules. Letters of the key words are taken in either case.
# A run that is too short can be left out by the pattern itself where matches are whole runs.
RULES = (
    Rule(
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.char_length(s))


def _matches(text: Column, rule: Rule) -> Column:
    """The rule's matches in order, each with the length of the gap before it."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        _lengths(F.split(text, rule.pattern, -1)).alias("gap"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("size"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("value"),
    )
    placed = F.transform(
        zipped,
        lambda part, place: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            place.alias("place"),
            part["gap"].alias("gap"),
            part["size"].alias("size"),
            (part["value"] >= rule.least).alias("counts"),
        ),
    )
    placed_type = "array<struct<kind:string,version:int,place:int,gap:int,size:int,counts:boolean>>"
    wanted = F.array_contains("_kinds", rule.kind) & text.rlike(rule.pattern)
    return F.when(wanted, placed).otherwise(F.array().cast(placed_type))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan_history(
    versions: DataFrame,
    ledger: str,
    rules: Sequence[Rule] = RULES,
    path_cols: Sequence[str] = ("path",),
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger lacks. Returns the addressed versions, and the findings of their blobs.

    The first frame has the path columns and ``blob``, one row per version; the second ``blob``,
    ``kind``, ``version``, ``start`` and ``end``, for the given rules. Findings are stored before
    the pairs they belong to: after a crash in between, a pair is scanned again and nothing is lost.
    """
    spark = versions.sparkSession
    kinds = {rule.kind: rule.version for rule in rules}
    text = F.coalesce(F.col(text_col), F.lit(""))
    paths = [F.col(name).alias(f"_p{i}") for i, name in enumerate(path_cols)]
    texts = versions.select(*paths, text.alias("_text"))
    keys = [f"_p{i}" for i in range(len(path_cols))]
    addressed = cut_lineage(texts.select(*keys, F.sha2("_text", 256).alias("blob")))

    one = F.min(F.struct(*keys)).alias("_from")
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("version")) for k, v in kinds.items()])
    blobs = addressed.groupBy("blob").agg(one).select("blob", "_from", F.inline(pairs))
    scanned = _stored(spark, f"{ledger}/scanned", _SCANNED)
    pending = cut_lineage(
        blobs.join(scanned, ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "_from")
        .agg(F.collect_set("kind").alias("_kinds"))
        .select("blob", "_kinds", *[F.col(f"_from.{key}").alias(f"_of{key}") for key in keys])
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of{key}"))
    # A path's other versions are told apart by their digest, worked out again for these paths only.
    unseen = texts.join(pending, same).where(F.sha2("_text", 256) == F.col("blob"))
    matches = unseen.select("blob", F.inline(F.concat(*[_matches(F.col("_text"), rule) for rule in rules])))
    before = Window.partitionBy("blob", "kind").orderBy("place")
    ends = (
        matches.distinct()
        .withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before))
        .where("counts")
    )
    ends.select("blob", "kind", "version", (F.col("end") - F.col("size")).cast("long").alias("start"),
                F.col("end").cast("long")).write.mode("append").parquet(f"{ledger}/findings")
    versions_of = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    pending.select("blob", F.explode("_kinds").alias("kind")).select(
        "blob", "kind", versions_of[F.col("kind")].alias("version")
    ).write.mode("append").parquet(f"{ledger}/scanned")

    current = F.lit(False)
    for kind, version in kinds.items():
        current = current | ((F.col("kind") == kind) & (F.col("version") == version))
    findings = _stored(spark, f"{ledger}/findings", _FINDINGS).where(current).distinct()
    named = [F.col(key).alias(name) for key, name in zip(keys, path_cols)]
    return addressed.select(*named, "blob"), findings


def findings_by_path(addressed: DataFrame, findings: DataFrame) -> DataFrame:
    """One row per version and finding in its blob."""
    return addressed.join(findings, "blob")


def digests(findings: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per blob with findings: the spans by start and rule as text, their digest, a count per kind."""
    order = F.lit(None).cast("int")
    for place, rule in enumerate(rules):
        order = F.when(F.col("kind") == rule.kind, place).otherwise(order)
    span = F.concat_ws(":", "kind", "start", "end")
    counts = [F.count_if(F.col("kind") == rule.kind).alias(f"n_{rule.kind}") for rule in rules]
    listed = F.sort_array(F.collect_list(F.struct("start", order.alias("rule"), span.alias("span"))))
    return (
        findings.groupBy("blob")
        .agg(*counts, listed.alias("listed"))
        .withColumn("spans", F.concat_ws(",", F.transform("listed", lambda x: x["span"])))
        .drop("listed")
    )


_ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r(kind, ord, p, g, least) AS (VALUES {rules}),
m AS (
  SELECT doc_id, kind, ord, least, regexp_extract_all(t, p) AS ms, string_split_regex(t, p) AS gs,
         regexp_extract_all(t, p, g) AS vs
  FROM d, r WHERE regexp_matches(t, p)
),
e AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, kind, ord, length(ms[i]) AS size,
         list_sum(list_transform(gs[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS st
  FROM e WHERE length(vs[i]) >= least
),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(st AS BIGINT) || ':' || CAST(st + size AS BIGINT), ','
                    ORDER BY st, ord) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""


def _sql() -> str:
    quoted = [rule.pattern.replace("'", "''") for rule in RULES]
    rows = [
        f"('{rule.kind}', {place}, '{pattern}', {rule.group}, {rule.least})"
        for place, (rule, pattern) in enumerate(zip(RULES, quoted))
    ]
    return _ORACLE.replace("{rules}", ", ".join(rows))


@query(sql=_sql())
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    addressed, findings = scan_history(docs, new_dir(spark, "secrets"), path_cols=["doc_id"])
    known = cut_lineage(digests(findings))
    counts = [F.coalesce(f"n_{rule.kind}", F.lit(0)).cast("long").alias(f"n_{rule.kind}") for rule in RULES]
    spans = F.coalesce("spans", F.lit(""))
    return addressed.join(known, "blob", "left").select(
        "doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )
