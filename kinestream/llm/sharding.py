"""Shards by jump consistent hashing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.llm.common import free_name

#: The multiplier of the 64-bit linear congruential step of jump consistent hashing.
_STEP = 2862933555777941757
#: Slots of a shard are counted in so many groups by id, and each in so many by checksum, so that no task holds a whole shard or all texts
#: of one id, such as null.
GROUPS, PARTS = 128, 32


def _times_step_plus_one(key: Column) -> Column:
    """key * _STEP + 1 modulo 2**64 on longs, by 16-bit limbs: no product or sum leaves a long."""
    k = [F.shiftrightunsigned(key, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    m = [F.lit(_STEP >> 16 * i & 0xFFFF).cast("long") for i in range(4)]
    parts, carry = [], F.lit(1).cast("long")
    for i in range(4):
        total = carry
        for j in range(i + 1):
            total = total + k[j] * m[i - j]
        parts.append(F.shiftleft(total.bitwiseAND(F.lit(0xFFFF)), 16 * i))
        carry = F.shiftright(total, 16)
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])


def jump_hash(key: Column, shards: int) -> Column:
    """The shard 0 to ``shards`` - 1 of a long key; null counts as -1.

    With one more shard a key stays or goes to the new one. Each jump goes forward, so ``shards`` steps do.
    """
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"), F.coalesce(key.cast("long"), F.lit(-1).cast("long")).alias("key"))

    def step(x: Column, _: Column) -> Column:
        drawn = F.struct(x["next"].alias("at"), _times_step_plus_one(x["key"]).alias("key"))
        return F.when(x["next"] >= shards, x).otherwise(
            F.transform(F.array(drawn), lambda y: F.struct(y["at"].alias("at"), ((y["at"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftrightunsigned(y["key"], 33) + 1).cast("double"))).cast("long").alias("next"), y["key"].alias("key")))[0]
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda x: x["at"].cast("int"))


def slot_group(key: Column, checksum: Column) -> Column:
    """The group 0 to GROUPS * PARTS - 1 in which a row's slot is counted: bits of its key's first step that no first jump reads, then of its checksum."""
    by_key = F.shiftrightunsigned(_times_step_plus_one(F.coalesce(key.cast("long"), F.lit(-1).cast("long"))), 20).bitwiseAND(F.lit(GROUPS - 1))
    return (by_key * PARTS + checksum.bitwiseAND(F.lit(PARTS - 1))).cast("int")


def sharded(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs`` with its shard by the law ``key``: id and shard count alone decide.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; 1 for null), text_crc32 (unsigned CRC-32 of the UTF-8
    bytes; 0 for null), law, shard, slot (0, 1, 2 ... within a shard, by group, id, size and checksum) and
    grown_shard (the shard if there were one more). Null ids count as -1. Repeated rows get a slot each, in any
    order. Equal texts may be in different shards, as this law doesn't look at texts. An empty table gives no rows.

    Slots take two scans: the first counts rows by shard and group (at most shards * GROUPS * PARTS rows, summed up and
    broadcast), the second numbers rows within a shard and group. Only rows that are equal in id and text can't be told apart and share a group.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    checksum = F.crc32(F.encode(text, "UTF-8"))
    counted = docs.select(jump_hash(key, shards).alias("shard"), slot_group(key, checksum).alias("group")).groupBy("shard", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("shard", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    dealt = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        checksum.alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(key, shards).alias("shard"),
        slot_group(key, checksum).alias("group"),
        jump_hash(key, shards + 1).alias("grown_shard"),
    )
    within = Window.partitionBy("shard", "group").orderBy("doc_id", "size", "text_crc32")
    numbered = dealt.withColumn("at", F.row_number().over(within))
    return numbered.join(F.broadcast(starts), ["shard", "group"]).select("doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("at") - 1).alias("slot"), "grown_shard")


def with_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with its shard as one more column, kept apart from columns of that name; for ``write.partitionBy``."""
    return docs.withColumn(free_name(docs, name), jump_hash(F.col(id_col), shards))


#: DuckDB's form of the rows of ``sharded`` on ``documents`` for 16 shards. CRC-32 is worked out byte by byte.
ORACLE = f"""
WITH RECURSIVE
bits AS (SELECT i AS byte, i::UBIGINT AS c, 0 AS n FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS tab FROM bits WHERE n = 8),
keyed AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(doc_id, -1) AS k FROM documents),
points AS (SELECT rid, list_transform(string_split(t, ''), lambda c: unicode(c)::UBIGINT) AS cps FROM keyed WHERE t <> ''),
bytes AS (SELECT rid, flatten(list_transform(cps, lambda u: CASE
    WHEN u < 128 THEN [u]
    WHEN u < 2048 THEN [192 + (u >> 6), 128 + (u & 63)]
    WHEN u < 65536 THEN [224 + (u >> 12), 128 + ((u >> 6) & 63), 128 + (u & 63)]
    ELSE [240 + (u >> 18), 128 + ((u >> 12) & 63), 128 + ((u >> 6) & 63), 128 + (u & 63)] END)) AS bs FROM points),
sums AS (SELECT rid, xor(list_reduce(list_prepend(4294967295::UBIGINT, bs), lambda c, b: xor(tab[(xor(c, b) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT) AS crc FROM bytes, crc_table),
jumps AS (
  SELECT rid, (-1)::BIGINT AS pos, 0::BIGINT AS nxt,
    CASE WHEN k < 0 THEN (18446744073709551616::HUGEINT + k::HUGEINT)::UHUGEINT ELSE k::UHUGEINT END AS key FROM keyed
  UNION ALL
  SELECT rid, nxt, floor((nxt + 1)::DOUBLE * (2147483648.0::DOUBLE / ((drawn // 8589934592::UHUGEINT) + 1)::DOUBLE))::BIGINT, drawn
  FROM (SELECT rid, nxt, (key * {_STEP}::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS drawn FROM jumps WHERE nxt < 17)
),
placed AS (SELECT rid, max(pos) FILTER (WHERE pos < 16 AND pos >= 0) AS shard, max(pos) FILTER (WHERE pos < 17 AND pos >= 0) AS grown_shard FROM jumps GROUP BY rid),
grouped AS (SELECT k.rid, k.doc_id, strlen(k.t) + 1 AS size, coalesce(s.crc, 0)::BIGINT AS text_crc32, p.shard, p.grown_shard,
    ((((CASE WHEN k.k < 0 THEN (18446744073709551616::HUGEINT + k.k::HUGEINT)::UHUGEINT ELSE k.k::UHUGEINT END) * {_STEP}::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT) // 1048576::UHUGEINT % {GROUPS}::UHUGEINT)::INT AS grp
  FROM keyed k JOIN placed p USING (rid) LEFT JOIN sums s USING (rid))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY grp, text_crc32 % {PARTS}, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
FROM grouped
"""
