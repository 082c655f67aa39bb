"""Chat formatting with collapse of cumulative snapshots (native).

Logs keep a conversation once per turn: each record repeats the turns of the one before it. A
rolling hash per turn identifies every prefix of every conversation: two running ``bit_xor`` of
hashes that include the turn's place. A conversation whose last hash is an inner prefix of another
one is dropped by an anti-join on (length, hashes); of equal conversations the smallest id stays.
Both sides of the anti-join are distinct hashes, counted before their shuffle, so a first turn or a
conversation that a third of the log shares is one row. What is left is rendered.

Defined results: turns are ordered by turn, role and text, nulls first, and counted from 1, so
repeated rows are turns of their own; a null role or text is rendered as empty but differs from an
empty one; rows with a null conv_id are one conversation; an empty table gives none. A conversation
is one row of the result, so its turns meet in one task; nothing else is gathered by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.common import written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rendered_turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(OPEN), F.coalesce(role, empty), F.lit("\n"), F.coalesce(text, empty), F.lit(CLOSE))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text) of the maximal conversations of (conv_id, turn, role, text)."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    numbered = turns.select("conv_id", "turn", "role", "text").withColumn("place", place)
    marks = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    hashed = numbered.withColumns({"one": F.xxhash64(*marks), "two": F.xxhash64(F.lit("second"), *marks)})
    hashed = hashed.withColumns({"one": F.bit_xor("one").over(so_far), "two": F.bit_xor("two").over(so_far)})
    turn = F.struct("place", "one", "two", rendered_turn(F.col("role"), F.col("text")).alias("text"))
    whole = written(
        hashed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
            "conv_id", F.size("turns").alias("n_turns"), F.element_at("turns", -1)["one"].alias("one"),
            F.element_at("turns", -1)["two"].alias("two"),
            F.transform("turns", lambda t: F.struct(t["place"].alias("n_turns"), t["one"].alias("one"), t["two"].alias("two"))).alias("prefixes"),
            F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("text"),
        ), "chat",
    )
    key = ["n_turns", "one", "two"]
    inner = whole.select(F.explode(F.slice("prefixes", F.lit(1), F.col("n_turns") - 1)).alias("p")).select("p.*").distinct()
    ends = whole.groupBy(*key).agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("first"))
    kept = ends.join(inner, key, "left_anti").select(F.col("first.conv_id").alias("_kept"))
    return whole.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")), "left_semi").select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), "text"
    )


def result(turns: DataFrame) -> DataFrame:
    """Rendered maximal conversations with the digest of their text."""
    return format_conversations(turns).withColumn("sha256", F.sha2("text", 256))


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER w AS place,
    (role IS NULL)::VARCHAR || '|' || coalesce(role, '') || '|' || (text IS NULL)::VARCHAR || '|' || length(coalesce(text, ''))::VARCHAR || '|' || coalesce(text, '') AS mark,
    '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS shown
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), p AS (
  SELECT conv_id, place, string_agg(mark, chr(0)) OVER (PARTITION BY conv_id ORDER BY place) AS prefix,
    count(*) OVER (PARTITION BY conv_id) AS n FROM t
), c AS (
  SELECT conv_id, n, prefix, row_number() OVER (PARTITION BY prefix ORDER BY conv_id NULLS LAST) AS copy FROM p WHERE place = n
), m AS (
  SELECT * FROM c WHERE copy = 1 AND NOT EXISTS (SELECT 1 FROM p WHERE p.place < p.n AND p.prefix = c.prefix)
)
SELECT m.conv_id, m.n AS n_turns, string_agg(t.shown, '' ORDER BY t.place) AS text, sha256(string_agg(t.shown, '' ORDER BY t.place)) AS sha256
FROM m JOIN t ON t.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY m.conv_id, m.n
"""
