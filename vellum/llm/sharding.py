"""Rendezvous hashing of record keys over weighted shards, in DataFrame functions only.

A record goes to the shard with the highest score, -weight / ln(u), where u in (0, 1) comes from the first 52 bits
of md5("key/shard"). Scores of a shard do not depend on the other shards, so one more shard only takes records into
itself, and a changed weight moves records only to or from that shard. With equal weights u itself is the score.

A null key counts as the text "null". A null text has no bytes and the checksum of an empty one. Repeated rows each
get a slot. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import stored, text_or_empty

SHARDS = 40
OVERHEAD = 16
#: Rows that get their slots in one sorted group; a shard has as many groups as its rows need.
SLOT_GROUP = 20_000


def scores(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """Array of (score, -shard) for each shard; the greatest one wins, the smallest shard at ties."""
    name = F.coalesce(key.cast("string"), F.lit("null"))
    bits = lambda s: F.conv(F.substring(F.md5(F.concat_ws("/", name, s.cast("string"))), 1, 13), 16, 10).cast("long")
    if weights is None or len(set(weights)) == 1:
        score = bits
    else:
        of = F.array(*(F.lit(float(w)) for w in weights))
        score = lambda s: -F.get(of, s) / F.log((bits(s) + 0.5) / float(1 << 52))
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(score(s).alias("score"), (-s).alias("shard")))


def rendezvous(df: DataFrame, key: str, shards: int = SHARDS, weights: Sequence[float] | None = None, shard: str = "shard", grown: str | None = "grown_shard", grown_weight: float = 1.0) -> DataFrame:
    """df with the column ``shard``, and ``grown``: the shard if there were one more (of grown_weight)."""
    if weights is not None and (len(weights) != shards or min(weights) <= 0):
        raise ValueError("one positive weight for each shard")
    w = None if weights is None else [*weights, grown_weight]
    df = df.withColumn("_scores", scores(F.col(key), shards + bool(grown), w))
    df = df.withColumn(shard, (-F.array_max(F.slice("_scores", 1, shards))["shard"]).cast("int"))
    if grown:
        df = df.withColumn(grown, (-F.array_max("_scores")["shard"]).cast("int"))
    return df.drop("_scores")


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], slot: str = "slot", group_rows: int = SLOT_GROUP) -> DataFrame:
    """A gapless number from 0 in each shard. Rows are numbered in groups of some group_rows that a hash deals out;
    the sums of the groups before give each group its first number. rows: a stored table, as it is read twice."""
    groups = 1 + rows.count() // (group_rows * SHARDS)
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = rows.groupBy(shard, "_group").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(shard, "_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy(shard, "_group").orderBy(*order))
    numbered = rows.withColumn("_n", within - 1).join(first, [shard, "_group"])
    return numbered.withColumn(slot, (F.col("_first") + F.col("_n")).cast("long")).drop("_first", "_n", "_group")


def assign(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs (doc_id, text)."""
    text = text_or_empty()
    narrow = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = stored(rendezvous(narrow, "doc_id", shards, weights), "sharded")
    placed = with_slots(dealt, "shard", ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


ORACLE_SQL = f"""
WITH best AS (
  SELECT doc_id, coalesce(text, '') AS t, list_transform(range({SHARDS + 1}), lambda s: {{'score':
    ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, 'null'), '/', s::VARCHAR)), 1, 13))::BIGINT, 'shard': -s}}) AS a
  FROM documents),
bytes AS (
  SELECT doc_id, strlen(t) + {OVERHEAD} AS size, -list_max(a[1:{SHARDS}]).shard AS shard, -list_max(a).shard AS grown_shard,
    list_transform(range(strlen(t)), lambda i: ('0x' || substr(hex(encode(t)), 2 * i + 1, 2))::BIGINT) AS b FROM best),
summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8,
    ({_crc_table()}::BIGINT[])[1 + (xor(c, x) & 255)])), 4294967295::BIGINT) AS text_crc32 FROM bytes)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard, grown_shard::INT AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot
FROM summed
"""
