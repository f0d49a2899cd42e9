"""Chat formatting: each dialogue rendered once per participant, with that speaker as the assistant.

In a rendering the chosen speaker's messages stand under ``assistant``, all other speakers' under
``user name=...``, and system messages under ``system``. The mask lists the spans of the text that a
model is trained on: the assistant's contents, each with its end mark.

A dialogue is rendered in numbered parts of at most ``per_part`` messages, so that one with a third
of all rows becomes many rows of bounded size; nothing is left out. Every part is rendered for all who
speak anywhere in the dialogue; where one is silent, the mask is empty. So the output is the dialogue
times its speakers. Messages are numbered by ``number_rows``, which spreads one large dialogue over
many tasks.

Defined results: messages go by turn (null first), then role and text; repeated rows are repeated
messages. A null text is empty, a null or empty role the speaker ``unknown``. White space, control
characters, ``<``, ``>`` and ``|`` in a speaker's name become ``_``. A mark inside a text is broken
up by a space, so that contents cannot forge messages. A null id is a dialogue like any other; one
that has only system messages gives no row, and an empty table none. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import load, query
from loadledger.operators.running import number_rows

# The marks of the chat template, and the role that is no participant.
START, END, SYSTEM = "<|im_start|>", "<|im_end|>", "system"
#: Messages in a part.
PER_PART = 64


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    per_part: int = PER_PART,
) -> DataFrame:
    """One row per dialogue, part and speaker: text, mask spans as code points, and their total."""
    role = F.when(F.col(role_col) != "", F.col(role_col))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.regexp_replace(F.coalesce(role, F.lit("unknown")), r"[\x00-\x20<>|]", "_").alias("speaker"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("text"),
    )
    numbered = number_rows(rows, ["conv"], ["turn", "speaker", "text"], "place")
    parts = numbered.groupBy("conv", F.floor((F.col("place") - 1) / per_part).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("place", "speaker", "text"))).alias("messages")
    )
    # Whoever speaks anywhere in a dialogue sees every part of it, also those of the others alone.
    speakers = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv").alias("_of"), F.col("speaker").alias("perspective"))
    views = parts.join(speakers.distinct(), F.col("conv").eqNullSafe(F.col("_of"))).drop("_of")
    own = F.col("perspective")

    def head(speaker):
        name = F.when(speaker == SYSTEM, SYSTEM).when(speaker == own, "assistant")
        return F.concat(F.lit(START), F.coalesce(name, F.concat(F.lit("user name="), speaker)), F.lit("\n"))

    segments = F.transform(
        "messages",
        lambda m: F.struct(
            head(m["speaker"]).alias("head"),
            F.concat(m["text"], F.lit(END)).alias("content"),
            (m["speaker"] == own).alias("own"),
        ),
    )
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans"))

    def advance(done, segment):
        begin = done["at"] + F.char_length(segment["head"])
        end = begin + F.char_length(segment["content"])
        span = F.array(F.struct(begin.alias("a"), end.alias("b")))
        spans = F.when(segment["own"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    mask = F.col("mask")
    return (
        views.withColumn("segments", segments)
        .withColumn("mask", F.aggregate("segments", empty, advance)["spans"])
        .select(
            F.col("conv").alias(conv_col),
            "part",
            "perspective",
            F.size("messages").alias("n_messages"),
            F.concat_ws("", F.transform("segments", lambda s: F.concat(s["head"], s["content"], F.lit("\n")))).alias(
                "text"
            ),
            F.concat_ws(",", F.transform(mask, lambda s: F.concat_ws(":", s["a"], s["b"]))).alias("mask_spans"),
            F.aggregate(mask, F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_masked"),
        )
    )


@query(
    sql=rf"""
WITH t AS (
  SELECT conv_id, turn,
         regexp_replace(coalesce(nullif(role, ''), 'unknown'), '[\x00-\x20<>|]', '_', 'g') AS speaker,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS body
  FROM conversations
),
n AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) AS place
  FROM t
),
p AS (SELECT *, (place - 1) // {PER_PART} AS part FROM n),
v AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
s AS (
  SELECT p.conv_id, p.part, v.perspective, p.place, p.speaker = v.perspective AS own,
         '{START}' || CASE WHEN p.speaker = '{SYSTEM}' THEN '{SYSTEM}'
                           WHEN p.speaker = v.perspective THEN 'assistant'
                           ELSE 'user name=' || p.speaker END || chr(10) AS head,
         body || '{END}' AS content
  FROM p JOIN v ON p.conv_id IS NOT DISTINCT FROM v.conv_id
),
o AS (
  SELECT *, sum(length(head) + length(content) + 1) OVER (
    PARTITION BY conv_id, part, perspective ORDER BY place) - 1 AS b
  FROM s
)
SELECT conv_id, part, perspective, CAST(count(*) AS INTEGER) AS n_messages,
       string_agg(head || content || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CAST(b - length(content) AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY place)
         FILTER (own), '') AS mask_spans,
       CAST(coalesce(sum(length(content)) FILTER (own), 0) AS BIGINT) AS n_masked
FROM o GROUP BY conv_id, part, perspective
"""
)
def op4_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
