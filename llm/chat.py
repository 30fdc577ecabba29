"""Chat formatting of maximal conversations (cumulative-snapshot collapse).

Chats are logged again and again as they grow. Each turn gets two hashes of its place, role and
text; their running sums identify every prefix of a conversation. A conversation whose whole hash
is the hash of a proper prefix of another one is dropped by an anti-join, equal conversations leave
the smallest id, and only what stays is rendered.

Turns are ordered by (turn, role, text), NULLs first, and numbered anew; a row that repeats an
earlier one in all four columns is the same turn. NULL roles render as "user", NULL texts as empty,
and both are told apart from the values "user" and "" when compared. Rows without conv_id form one
conversation. An empty table gives no rows. Other columns are ignored. A conversation is rendered
into one row, so a group is as long as one output text; hashing needs no texts in its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.registry import query, stored, table

#: Bits of each of the two hashes; running sums of 2**23 turns still fit a long.
MASK = (1 << 40) - 1
NO_ID = -(1 << 63)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, n, h1, h2, last): the hashes of the first n turns of each conversation."""
    marked = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = turns.select("conv", "turn", marked("role").alias("role"), F.sha2(marked("text"), 256).alias("digest"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "digest")
    placed = rows.distinct().withColumns({"n": F.row_number().over(order), "size": F.count(F.lit(1)).over(Window.partitionBy("conv"))})
    one = lambda seed: F.xxhash64(F.lit(seed), F.col("n"), F.col("role"), F.col("digest")).bitwiseAND(F.lit(MASK))
    running = Window.partitionBy("conv").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select("conv", "n", F.sum(one("a")).over(running).alias("h1"), F.sum(one("b")).over(running).alias("h2"),
                         (F.col("n") == F.col("size")).alias("last"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that no other one continues."""
    prefixes = stored(prefix_hashes(turns), "prefixes")
    key = ["n", "h1", "h2"]
    whole = prefixes.filter("last").groupBy(*key).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_copies"))
    grown = prefixes.filter("NOT last").groupBy(*key).count().drop("count")
    return whole.join(grown, key, "left_anti").select("conv", F.col("n").cast("long").alias("n_turns"), "n_copies")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, text): one row per maximal conversation, rendered."""
    turns = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), "turn", "role", "text")
    kept = stored(maximal(turns), "maximal")
    texts = (turns.join(kept.select("conv"), "conv", "left_semi").distinct()
             .select("conv", F.struct("turn", F.coalesce(F.concat(F.lit("="), F.col("role")), F.lit("")).alias("marked"),
                                      F.sha2(F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("")), 256).alias("digest"),
                                      render(F.col("role"), F.col("text")).alias("line")).alias("turn_"))
             .groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list("turn_")), lambda x: x["line"]), "").alias("text")))
    return texts.join(kept, "conv").select(
        F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), "n_turns", "n_copies", "text")


#: The same by comparing the turns themselves.
SQL = """
WITH t AS (
  SELECT coalesce(conv_id, -9223372036854775808) AS conv, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce('=' || role, ''),
                            sha256(coalesce('=' || text, ''))) AS n
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
c AS (
  SELECT conv, count(*) AS n_turns, list(coalesce('=' || role, '') || chr(10) || coalesce('=' || text, '') ORDER BY n) AS turns,
         string_agg('<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY n) AS text
  FROM t GROUP BY conv),
p AS (SELECT DISTINCT list_slice(c.turns, 1, k.n) AS turns FROM c, LATERAL (SELECT unnest(range(1, c.n_turns)) AS n) AS k)
SELECT CASE WHEN min(c.conv) = -9223372036854775808 THEN NULL ELSE min(c.conv) END AS conv_id,
       max(c.n_turns) AS n_turns, count(*) AS n_copies, min(c.text) AS text
FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = c.turns)
GROUP BY c.turns
"""


@query("op2_chat", SQL)
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))
