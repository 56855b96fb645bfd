"""Preference formatting: the longest common turn prefix of two conversations as one prompt, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
TURN = "struct<turn:bigint,role:string,text:string>"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """start-end of what the loss sees, comma-joined: text and end mark of assistant turns, code points of the rendering."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(turn["role"]) + F.lit(5)
        end = begin + F.length(turn["text"]) + F.lit(len(END))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], F.array(F.concat_ws("-", begin.cast("string"), end.cast("string"))))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, first, step, lambda s: F.array_join(s["spans"], ","))


def _clean(turn: Column, role: Column, text: Column) -> Column:
    return F.struct(turn.cast("long").alias("turn"), F.coalesce(role, F.lit("unknown")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """One row per row of pairs (pair_id, c, r: the turns of the chosen and the rejected conversation, in order)."""
    shorter = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    pairs = pairs.withColumn("p", F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, shorter).cast("int"))
    rest = lambda side: F.slice(side, F.col("p") + 1, F.greatest(F.size(side) - F.col("p"), F.lit(0)))
    pairs = pairs.withColumn("ct", rest("c")).withColumn("rt", rest("r"))
    there = lambda side, value: F.when(F.size(side) > 0, value)
    return pairs.select(
        "pair_id", F.size("c").alias("n_chosen"), F.size("r").alias("n_rejected"), F.col("p").alias("n_prompt"),
        _render(F.slice("c", 1, F.col("p"))).alias("prompt"),
        there("c", _render(F.col("ct"))).alias("chosen"), there("r", _render(F.col("rt"))).alias("rejected"),
        there("c", _mask(F.col("ct"))).alias("chosen_mask"), there("r", _mask(F.col("rt"))).alias("rejected_mask"),
    )


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair of turns (pair_id, rejected boolean, turn, role, text; other columns are left behind).

    Turns are ordered by number, then role, then text, so ties and repeated rows have one order and stay. A null role is
    "unknown", a null text empty, a null turn number comes first. Rows without a pair are in no result. A pair with one
    side has an empty prompt and a null other completion. Two equal conversations are all prompt, with empty completions.
    A pair becomes one row, so its conversations have to fit one task, as any rendered conversation has to.
    """
    clean = turns.filter("pair_id IS NOT NULL").select("pair_id", "rejected", _clean(F.col("turn"), F.col("role"), F.col("text")).alias("t"))
    side = lambda other: F.array_sort(F.collect_list(F.when(F.col("rejected") == other, F.col("t"))))
    return format_pairs(clean.groupBy("pair_id").agg(side(F.lit(False)).alias("c"), side(F.lit(True)).alias("r")))


def branched(conversations: DataFrame) -> DataFrame:
    """pair_id, c, r of every conversation (conv_id, turn, role, text), branched at its last assistant turn.

    Chosen is the conversation up to that turn; rejected is the same with that answer broken off in the middle. Turns behind
    it are no part of a pair. A conversation without such a turn, or whose last answer is empty, is all prompt. Rows without
    an id are in no result. Nulls, ties and repeated rows are as in format_preferences.
    """
    clean = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").alias("pair_id"), _clean(F.col("turn"), F.col("role"), F.col("text")).alias("t"))
    whole = clean.groupBy("pair_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    back = F.array_position(F.reverse(F.transform("t", lambda x: x["role"])), F.lit("assistant"))
    whole = whole.withColumn("last", F.when(back > 0, F.size("t") - back + 1).otherwise(0).cast("int"))
    cut = lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), F.substring(x["text"], F.lit(1), F.floor(F.length(x["text"]) / 2).cast("int")).alias("text"))
    chosen = F.when(F.col("last") > 0, F.slice("t", 1, F.col("last"))).otherwise(F.col("t"))
    broken = F.concat(F.slice("t", 1, F.greatest(F.col("last") - 1, F.lit(0))), F.transform(F.slice("t", F.greatest(F.col("last"), F.lit(1)), 1), cut))
    return whole.select("pair_id", chosen.alias("c"), F.when(F.col("last") > 0, broken).otherwise(F.col("t")).alias("r"))


SQL = """
WITH t AS (SELECT conv_id AS pair_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, coalesce(max(i) FILTER (role = 'assistant'), 0) AS last, count(*) AS n FROM t GROUP BY pair_id),
r AS (SELECT t.*, l.last, CASE WHEN l.last = 0 THEN n ELSE l.last END AS k, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body,
  '<|' || role || '|>' || chr(10) || substr(text, 1, length(text) // 2) || '<|end|>' || chr(10) AS broken FROM t JOIN last l USING (pair_id)),
p AS (SELECT pair_id, any_value(k) AS k, any_value(k) - coalesce(max(CASE WHEN i = last AND body <> broken THEN 1 END), 0) AS p FROM r GROUP BY pair_id)
SELECT pair_id, p.k::INT AS n_chosen, p.k::INT AS n_rejected, p.p::INT AS n_prompt, coalesce(string_agg(body, '' ORDER BY i) FILTER (i <= p.p), '') AS prompt,
  coalesce(max(CASE WHEN i > p.p AND i <= p.k THEN body END), '') AS chosen, coalesce(max(CASE WHEN i > p.p AND i <= p.k THEN broken END), '') AS rejected,
  coalesce(max(CASE WHEN i > p.p AND i <= p.k THEN '14-' || length(body) END), '') AS chosen_mask, coalesce(max(CASE WHEN i > p.p AND i <= p.k THEN '14-' || length(broken) END), '') AS rejected_mask
FROM r JOIN p USING (pair_id) GROUP BY pair_id, p.k, p.p
"""
