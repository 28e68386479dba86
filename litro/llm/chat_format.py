"""Preference pairs: the common opening of two conversations as prompt, the rest as masked completions. Native functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import table

START, END = "<|im_start|>", "<|im_end|>\n"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["rendered"]), "")


def _spans(turns: Column) -> Column:
    """[start, end) in code points of what the loss reads: the text and end mark of each assistant turn."""
    zero = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(F.lit(0).cast("long").alias("at"), zero.alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(turn["rendered"])
        span = F.struct((state["at"] + F.length(F.lit(START)) + F.length(turn["role"]) + 1).cast("long").alias("start"), end.cast("long").alias("end"))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, first, add, lambda s: s["spans"])


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array of (turn, role, text, rendered)), in the order of turn, role and text; equal rows count once.

    A missing role is "user", a missing text is empty; rows without conv_id or turn belong to no conversation.
    A conversation is one record: its length is bound by what a row can hold.
    """
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("user")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    rendered = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END))
    turn = F.struct("turn", "role", "text", rendered.alias("rendered"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each row of pairs (chosen_id, rejected_id): prompt, completions and their loss spans.

    The prompt is the longest common prefix of turns, equal in role and text, rendered once; it
    carries no loss. chosen and rejected are the rendered remaining turns, chosen_loss and
    rejected_loss the spans of assistant turns in them. Where both are equal, both completions are
    empty. An id that is null or has no turns gives an empty prompt and a null completion on its
    side. Repeated pairs are formatted each. Empty tables give no rows, or null completions.
    """
    talks = conversations(turns)
    pairs = pairs.select(pairs["chosen_id"].cast("long").alias("chosen_id"), pairs["rejected_id"].cast("long").alias("rejected_id"))
    both = pairs.join(talks.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("yes")), "chosen_id", "left")
    both = both.join(talks.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("no")), "rejected_id", "left")
    least = F.coalesce(F.least(F.size("yes"), F.size("no")), F.lit(0))
    least = F.when(F.col("yes").isNull() | F.col("no").isNull(), 0).otherwise(least)
    differ = F.zip_with("yes", "no", lambda a, b: ~(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])))
    # Turns before the first difference; -1 if there is none.
    same = F.array_position(differ, True) - 1
    common = F.when(least == 0, 0).when(same < 0, least).otherwise(same).cast("int")
    split = both.withColumn("n_prompt", common)
    rest = lambda c: F.slice(c, F.col("n_prompt") + 1, F.greatest(F.size(c), F.lit(0)))
    split = split.select("chosen_id", "rejected_id", F.col("n_prompt").cast("long").alias("n_prompt_turns"), F.slice("yes", 1, F.col("n_prompt")).alias("prompt"), rest("yes").alias("yes"), rest("no").alias("no"))
    return split.select(
        "chosen_id",
        "rejected_id",
        "n_prompt_turns",
        F.coalesce(_rendered(F.col("prompt")), F.lit("")).alias("prompt"),
        _rendered(F.col("yes")).alias("chosen"),
        _rendered(F.col("no")).alias("rejected"),
        _spans(F.col("yes")).alias("chosen_loss"),
        _spans(F.col("no")).alias("rejected_loss"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table names no preferences: conversation 2k is taken as chosen over 2k + 1, an unpaired one has no rejected."""
    turns = table(spark, sf_dir, "conversations")
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
    even = F.col("conv_id") % 2 == 0
    pairs = ids.groupBy(F.shiftright("conv_id", 1).alias("pair")).agg(
        F.max(F.when(even, F.col("conv_id"))).alias("chosen_id"), F.max(F.when(~even, F.col("conv_id"))).alias("rejected_id")
    )
    done = format_preferences(turns, pairs)
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return done.select("chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "rejected", spans("chosen_loss").alias("chosen_loss"), spans("rejected_loss").alias("rejected_loss"))


ORACLE = f"""
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
numbered AS (
  SELECT *, '{START}' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM rows),
ids AS (SELECT DISTINCT conv_id, conv_id // 2 AS pair FROM rows),
pairs AS (SELECT pair, max(conv_id) FILTER (conv_id % 2 = 0) AS chosen_id, max(conv_id) FILTER (conv_id % 2 = 1) AS rejected_id FROM ids GROUP BY pair),
met AS (
  SELECT p.pair, a.k, (a.role = b.role AND a.text = b.text) AS same
  FROM pairs p JOIN numbered a ON a.conv_id = p.chosen_id JOIN numbered b ON b.conv_id = p.rejected_id AND b.k = a.k),
prompts AS (
  SELECT p.*, CASE WHEN p.chosen_id IS NULL OR p.rejected_id IS NULL THEN 0
    ELSE coalesce((SELECT min(k) - 1 FROM met WHERE met.pair = p.pair AND NOT same), (SELECT max(k) FROM met WHERE met.pair = p.pair), 0) END AS n
  FROM pairs p),
rest AS (
  SELECT p.pair, s.side, t.k, t.role, t.rendered,
    coalesce(sum(length(t.rendered)) OVER (PARTITION BY p.pair, s.side ORDER BY t.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM prompts p, (VALUES ('chosen'), ('rejected')) s(side), numbered t
  WHERE t.conv_id = CASE s.side WHEN 'chosen' THEN p.chosen_id ELSE p.rejected_id END AND t.k > p.n),
sides AS (
  SELECT pair, side, string_agg(rendered, '' ORDER BY k) AS rendered,
    string_agg((pos + {len(START)} + length(role) + 1)::BIGINT || ':' || (pos + length(rendered))::BIGINT, ',' ORDER BY k) FILTER (role = 'assistant') AS loss
  FROM rest GROUP BY pair, side)
SELECT p.chosen_id, p.rejected_id, p.n::BIGINT AS n_prompt_turns,
  coalesce((SELECT string_agg(rendered, '' ORDER BY k) FROM numbered t WHERE t.conv_id = p.chosen_id AND t.k <= p.n), '') AS prompt,
  CASE WHEN p.chosen_id IS NOT NULL THEN coalesce(a.rendered, '') END AS chosen,
  CASE WHEN p.rejected_id IS NOT NULL THEN coalesce(b.rendered, '') END AS rejected,
  CASE WHEN p.chosen_id IS NOT NULL THEN coalesce(a.loss, '') END AS chosen_loss,
  CASE WHEN p.rejected_id IS NOT NULL THEN coalesce(b.loss, '') END AS rejected_loss
FROM prompts p LEFT JOIN sides a ON a.pair = p.pair AND a.side = 'chosen' LEFT JOIN sides b ON b.pair = p.pair AND b.side = 'rejected'
"""
