"""Rendered chats of logged conversations, with snapshots collapsed; DataFrame functions only.

A chat that is logged again after every turn leaves a row of snapshots, each a prefix of the next. The hash of a prefix rolls:
every turn adds, by exclusive or, 120 bits of SHA-256 over its place, role and text. A conversation is a snapshot if its
whole hash and length stand among the proper prefixes of another one; an anti-join on distinct hashes keeps the maximal
conversations, and only these are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# The marks around a turn.
OPEN_MARK, CLOSE_MARK = "<|im_start|>", "<|im_end|>"
NO_ROLE = "unknown"


def _bits(digest: Column, first: int) -> Column:
    """Sixty bits of a digest in hexadecimal digits."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def hashed_turns(turns: DataFrame) -> DataFrame:
    """Distinct turns in their order, each with the hash of the conversation up to it.

    ``conv_id``, ``place`` (from 1), ``n_turns``, ``role``, ``text``, ``hash_a``, ``hash_b``.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(NO_ROLE)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.lag(c).over(order).eqNullSafe(F.col(c)) for c in ("turn", "role", "text")]
    first = rows.select("*", F.when((F.row_number().over(order) > 1) & same[0] & same[1] & same[2], 0).otherwise(1).alias("new"))
    placed = first.withColumn("place", F.sum("new").over(so_far)).where("new = 1").drop("new", "turn")
    said = F.concat_ws(":", "place", F.length("role"), "role", "text")
    own = placed.withColumn("digest", F.sha2(said.cast("binary"), 256))
    own = own.withColumns({"own_a": _bits(F.col("digest"), 1), "own_b": _bits(F.col("digest"), 16)}).drop("digest")
    by_place = Window.partitionBy("conv_id").orderBy("place")
    rolled = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    return own.select(
        "conv_id",
        "place",
        F.max("place").over(whole).alias("n_turns"),
        "role",
        "text",
        F.bit_xor("own_a").over(rolled).alias("hash_a"),
        F.bit_xor("own_b").over(rolled).alias("hash_b"),
    )


def rendered_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations as one text each: ``conv_id``, ``n_turns``, ``n_copies``, ``chat``.

    Turns follow ``turn``, then role and text; null turns come first. Repeated rows are one turn. Of equal conversations the
    smallest conv_id stays and ``n_copies`` counts them; conversations that a longer one begins with are left out, as are
    turns without conv_id. A null role counts as ``unknown``, null text as empty. Further columns are not looked at.
    """
    hashed = cut_lineage(hashed_turns(turns))
    hashes = ("hash_a", "hash_b")
    logged = (
        hashed.where(F.col("place") == F.col("n_turns"))
        .groupBy(*hashes, "n_turns")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    prefixes = hashed.where(F.col("place") < F.col("n_turns")).select(*hashes, F.col("place").alias("n_turns")).distinct()
    maximal = logged.join(prefixes, [*hashes, "n_turns"], "left_anti").select("conv_id", "n_copies")
    turn = F.concat(F.lit(OPEN_MARK), "role", F.lit("\n"), "text", F.lit(CLOSE_MARK + "\n"))
    said = F.sort_array(F.collect_list(F.struct("place", turn.alias("said"))))
    return (
        hashed.join(maximal, "conv_id")
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(said.alias("turns"))
        .select("conv_id", "n_turns", "n_copies", F.array_join(F.col("turns.said"), "").alias("chat"))
    )


CHATS_SQL = """WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
  count(*) OVER (PARTITION BY conv_id) AS n_turns FROM turns),
prefixes AS (SELECT conv_id, place, n_turns, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
  OVER (PARTITION BY conv_id ORDER BY place) AS chat FROM placed),
logged AS (SELECT chat, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE place = n_turns
  GROUP BY chat, n_turns)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, n_copies, chat FROM logged l WHERE NOT EXISTS (
  SELECT 1 FROM prefixes p WHERE p.place < p.n_turns AND p.place = l.n_turns AND p.chat = l.chat)"""
