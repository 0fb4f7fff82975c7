"""Sharding by rendezvous hashing (native: SQL functions only).

Every shard has a name (a whole number) and a weight. A record's key and a shard's name
give a number ``u`` in (0, 1), the first 52 bits of an MD5 digest; the record goes to the
shard with the smallest ``-ln(u) / weight``. Digest and logarithm are the same on every
machine and in every version, so a key keeps its shard for good:

* a shard gets keys in proportion to its weight;
* a new shard takes keys only into itself, about its share of the weight;
* a shard that goes gives up only its own keys;
* a changed weight moves keys only into or out of that shard.

The choice is one expression over the key, without a shuffle (``assign``). ``manifest``
also numbers the records of each shard from 0. The order in a shard is that of an MD5
digest over the record's key, size and checksum, so no order of arrival and no task
decides it. Equal records are counted before they are shuffled and go on as pieces of at
most ``PIECE`` records with digests of their own; runs of the digest are numbered on their
own, with offsets from sums of counts. So neither a full shard nor a key that holds a
third of all rows becomes one task.

Cases: a null text has no bytes (size 1, checksum 0), as an empty text has; records without a
key share one key of their own, which no other key equals; repeated rows are records of
their own with consecutive slots; records that share a key share a shard; an empty table
gives no rows; of very long texts only size and checksum travel. Extra columns, whatever
their names, stay in ``assign`` (a column of the name of the result is replaced) and are
ignored by ``manifest``. Keys are compared as text: 7 and '7' are one key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 20_000
PIECE = 10_000
PREFIX_BITS = 20


def even(n: int) -> dict[int, int]:
    """Shards 0 to n - 1 of equal weight."""
    return {s: 1 for s in range(n)}


def _draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) from key and shard: 52 bits, never 0 or 1."""
    named = F.concat(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null")), F.lit(f"@{shard}"))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def shard_of(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard of a key among ``{name: weight}``; ties, which 52 bits leave out in
    practice, go to the smaller name. Shards of weight 0 get nothing."""
    live = {s: w for s, w in sorted(shards.items()) if w > 0}
    if not live:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*[
        F.struct((-F.ln(_draw(key, s)) / F.lit(float(w))).alias("cost"), F.lit(s).cast("int").alias("shard"))
        for s, w in live.items()]))["shard"]


def assign(records: DataFrame, shards: Mapping[int, float], key: str = "doc_id", into: str = "shard") -> DataFrame:
    """``records`` with the column ``into``; nothing is shuffled."""
    return records.withColumn(into, shard_of(records[key], shards))


def moved(records: DataFrame, old: Mapping[int, float], new: Mapping[int, float], key: str = "doc_id") -> DataFrame:
    """The records that change their shard, with ``old_shard`` and ``new_shard``."""
    both = assign(assign(records, old, key, "old_shard"), new, key, "new_shard")
    return both.filter("old_shard <> new_shard")


def write_shards(records: DataFrame, shards: Mapping[int, float], path: str, key: str = "doc_id") -> None:
    """Whole records as Parquet, one folder a shard. Each task writes what it reads; a
    shard's files are as many as the tasks that had rows for it."""
    assign(records, shards, key).write.partitionBy("shard").parquet(path)


def manifest(records: DataFrame, shards: Mapping[int, float], grown: Mapping[int, float] | None = None,
             key: str = "doc_id", text: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard``: one row a record. ``grown`` are
    the shards of the next growth (null: no such column filled).

    Shuffled are (key, size, checksum, count) alone. A chunk is a run of the ordering digest and
    has about ``chunk_rows`` records, however many there are."""
    total = records.count()
    bits = min(PREFIX_BITS, max(0, (max(total, 1) - 1) // chunk_rows).bit_length())
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = records.select(F.col(key).alias("k"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
                          F.crc32(body).alias("crc"))
    counted = rows.groupBy("k", "size", "crc").agg(F.count(F.lit(1)).alias("all"))
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("all") - 1, F.lit(PIECE))).alias("from"))
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("k").cast("string"), F.lit("null")), "size", "crc", "from")
                   .cast("binary"))
    prefix = F.conv(F.substring(digest, 1, PREFIX_BITS // 4), 16, 10).cast("int")
    placed = pieces.select(
        "k", "size", "crc", F.least(F.col("all") - F.col("from"), F.lit(PIECE)).alias("n"),
        shard_of(F.col("k"), shards).alias("shard"), digest.alias("d"),
        F.shiftright(prefix, PREFIX_BITS - bits).alias("chunk"))
    # numbers within a chunk, then the records of the chunks before it: sums over blocks of
    # chunks first, so that no window holds more than about a thousand rows a shard
    inner = Window.partitionBy("shard", "chunk").orderBy("d", "k", "size", "crc")
    local = placed.withColumn("upto", F.sum("n").over(inner))
    sums = local.groupBy("shard", "chunk").agg(F.sum("n").alias("c")).withColumn("block", F.shiftright("chunk", 10))
    in_block = Window.partitionBy("shard", "block").orderBy("chunk")
    blocks = sums.groupBy("shard", "block").agg(F.sum("c").alias("b"))
    starts = blocks.select("shard", "block", (F.sum("b").over(Window.partitionBy("shard").orderBy("block")) - F.col("b"))
                           .alias("block_start"))
    offsets = (sums.withColumn("at", F.sum("c").over(in_block) - F.col("c")).join(starts, ["shard", "block"])
               .select("shard", "chunk", (F.col("at") + F.col("block_start")).alias("start")))
    first = F.col("start") + F.col("upto") - F.col("n")
    wide = shard_of(F.col("k"), grown) if grown else F.lit(None).cast("int")
    return (local.join(offsets, ["shard", "chunk"])
            .select("k", "size", "crc", "shard", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"))
            .select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot",
                    wide.alias("grown_shard")))
