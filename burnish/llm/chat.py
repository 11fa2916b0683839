"""Multi-party perspective rotation for chat training, with DataFrame functions only.

A dialogue is rendered once for each participant: that speaker's messages become the
assistant's, every other speaker is a named user, system messages stay system messages.
Only the assistant's words and their end mark are learnt from; ``masks`` lists those spans
as ``start:end`` (code points of ``text``, end exclusive), comma-joined.

A dialogue is cut into parts of ``PART`` messages by their position in it, so one of up to
``PART`` messages with turns is whole whatever its turns are, no task collects an unbounded
group, and parts in order give the whole dialogue.  A part is named by its first turn:
``block`` is that turn divided by ``PART``, ``chunk`` counts the parts of one block.  Messages
without a turn have no place among the others and come in parts of their own, with no block.

Positions are counted in two levels: messages are dealt into ranges of conversation, turn,
speaker and text, counted within a range, and added up over the ranges of a conversation.

Defined cases: a null text is an empty message; a null or blank role is the speaker
``unknown``; ``system`` is no participant; a null turn comes after the numbered ones; rows
of one turn are ordered by speaker, then text; exact repeats of a row count once; rows
without conv_id belong to no dialogue and give none; control marks inside a message are
broken up so that they cannot end it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burnish.session import materialise

PART = 256
LEAD = 64  # characters of a text that decide its range
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _placed(turns: DataFrame, part: int) -> DataFrame:
    """Adds ``block``, ``chunk`` and ``pos``, the place of a message in its dialogue."""
    order = [F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("said")]
    dealt = turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_last(), "speaker", F.substring("said", 1, LEAD))
    dealt = materialise(dealt.select("*", F.col("turn").isNull().alias("_late"), F.spark_partition_id().alias("_range")), "chat-ranges")
    dialogue = ["conv_id", "_late"]
    counts = dealt.groupBy(*dialogue, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*dialogue).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*dialogue, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(*dialogue, "_range").orderBy(*order)) - 1
    placed = dealt.withColumn("_rank", rank).join(offsets, [*dialogue, "_range"])
    placed = placed.withColumn("pos", F.col("_offset") + F.col("_rank")).withColumn("_part", F.floor(F.col("pos") / part).cast("long"))

    parts = placed.groupBy(*dialogue, "_part").agg(F.floor(F.min("turn") / part).cast("long").alias("block"))
    parts = parts.withColumn("_block", F.coalesce("block", F.lit(0)))
    firsts = parts.groupBy(*dialogue, "_block").agg(F.min("_part").alias("_first"))
    parts = parts.join(firsts, [*dialogue, "_block"]).select(*dialogue, "_part", "block", (F.col("_part") - F.col("_first")).alias("chunk"))
    return placed.join(parts, [*dialogue, "_part"]).drop("_late", "_range", "_offset", "_rank", "_part")


def rotate(conversations: DataFrame, part: int = PART) -> DataFrame:
    """One row per conversation, participant and part: rendered text and its masks."""
    role = F.trim(F.coalesce(F.col("role").cast("string"), F.lit("")))
    turns = (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.when(role == "", F.lit("unknown")).otherwise(role).alias("speaker"),
            F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"),
        )
        .groupBy("conv_id", "turn", "speaker", "said")
        .agg(F.count(F.lit(1)).alias("_n"))
        .drop("_n")
    )
    turns = _placed(turns, part)

    people = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", F.when(role == "", F.lit("unknown")).otherwise(role).alias("participant")).filter(F.col("participant") != "system").distinct()
    own = F.col("speaker") == F.col("participant")
    head = (
        F.when(F.col("speaker") == "system", F.lit(OPEN + "system\n"))
        .when(own, F.lit(OPEN + "assistant\n"))
        .otherwise(F.concat(F.lit(OPEN + "user name="), F.regexp_replace("speaker", "[^A-Za-z0-9_-]", "_"), F.lit("\n")))
    )
    rows = turns.join(people, "conv_id").withColumn("head", head)
    rows = rows.withColumn("segment", F.concat("head", "said", F.lit(CLOSE + "\n")))
    group = ["conv_id", "participant", "block", "chunk"]
    before = Window.partitionBy(*group).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("segment")).over(before), F.lit(0)) + F.length("head"))
    end = F.col("at") + F.length("said") + len(CLOSE)
    rows = rows.withColumn("mask", F.when(own, F.concat(F.col("at").cast("string"), F.lit(":"), end.cast("string"))))
    rows = rows.withColumn("learnt", F.when(own, end - F.col("at")).otherwise(F.lit(0)))
    done = rows.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("pos", "segment", "mask"))).alias("parts"),
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("learnt").cast("long").alias("n_learnt"),
    )
    return done.select(
        *group,
        "n_messages",
        "n_learnt",
        F.concat_ws("", F.col("parts.segment")).alias("text"),
        F.concat_ws(",", F.col("parts.mask")).alias("masks"),
    )


OP10_SQL = r"""
WITH base AS (
  SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn,
         CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations WHERE conv_id IS NOT NULL),
blocks AS (SELECT *, CAST(floor(turn / 256) AS BIGINT) AS block FROM base),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, block ORDER BY turn NULLS LAST, speaker, said) - 1 AS pos FROM blocks),
people AS (SELECT DISTINCT conv_id, speaker AS participant FROM base WHERE speaker <> 'system'),
headed AS (
  SELECT p.*, q.participant, p.pos // 256 AS chunk,
         CASE WHEN speaker = 'system' THEN '<|im_start|>system' WHEN speaker = participant THEN '<|im_start|>assistant'
              ELSE '<|im_start|>user name=' || regexp_replace(speaker, '[^A-Za-z0-9_-]', '_', 'g') END || chr(10) AS head
  FROM placed p JOIN people q USING (conv_id)),
spanned AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS segment,
         coalesce(sum(length(head) + length(said) + 11) OVER (PARTITION BY conv_id, participant, block, chunk ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM headed)
SELECT conv_id, participant, block, CAST(chunk AS BIGINT) AS chunk, count(*) AS n_messages,
       CAST(sum(CASE WHEN speaker = participant THEN length(said) + 10 ELSE 0 END) AS BIGINT) AS n_learnt,
       string_agg(segment, '' ORDER BY pos) AS text,
       coalesce(string_agg(CASE WHEN speaker = participant THEN CAST(start AS VARCHAR) || ':' || CAST(start + length(said) + 10 AS VARCHAR) END, ',' ORDER BY pos), '') AS masks
FROM spanned GROUP BY conv_id, participant, block, chunk
"""
