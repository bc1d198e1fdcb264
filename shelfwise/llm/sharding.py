"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows by seeded hashes into buckets that fit in memory: as many
as the rows and their bytes ask for.  Pass 2 lays the rows of a bucket out in a fixed
order and Fisher-Yates shuffles them (Spark's seeded ``shuffle`` of an array draws one
swap per position, from the seed, the number of the task's partition and the arrays
before it there).  Buckets are therefore dealt to partitions whose number follows the
buckets and not the session, and stand in order within them: the permutation depends
on rows and seed alone, not on shuffle partitions or adaptive execution.  The
buckets one after another are a random permutation of the table; position p
goes to shard ``p mod shards``, slot ``p div shards``, so shard sizes differ by
one row at most (law ``rows``).

DataFrame functions only.  Rows that are equal in every carried column are
first counted, then dealt out copy by copy, so a value that a third of the rows
share spreads over all buckets like any other.

Defined cases: a null text counts 16 bytes and has a null checksum; null and
repeated doc_ids are ordinary rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stage

SHARDS = 40
SEED = 20240607
#: Rows of one bucket on average: what a task holds at once.
BUCKET_ROWS = 4096
#: Bytes of one bucket on average, where rows are long.
BUCKET_BYTES = 64 << 20
#: Partitions that the buckets are dealt to, if there are as many.
PARTITIONS = 8192
#: Slots of one shard that a task writes together.
PIECE_ROWS = 1 << 16
COPY_CHUNK = 100_000


def one_row_per_copy(rows: DataFrame) -> DataFrame:
    """``rows`` with a copy number, which tells equal rows apart."""
    counted = rows.groupBy(*rows.columns).agg((F.count("*") - 1).alias("__most"))
    chunked = (counted.withColumn("__chunk", F.explode(F.expr(f"sequence(0L, __most div {COPY_CHUNK})")))
               .withColumn("__first", F.col("__chunk") * COPY_CHUNK))
    return (chunked.withColumn("__copy", F.explode(F.expr(f"sequence(__first, least(__first + {COPY_CHUNK - 1}, __most))")))
            .drop("__most", "__chunk", "__first"))


def shuffle_rows(rows: DataFrame, seed: int = SEED, bucket_rows: int = BUCKET_ROWS,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``rows`` with ``__position``, their place in a seeded random permutation
    of the whole table, gapless from 0.  The result is a staged table."""
    columns = rows.columns
    copies = one_row_per_copy(rows)
    long = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in rows.dtypes if t in ("string", "binary")]
    n, held = rows.agg(F.count("*"), F.coalesce(F.sum(sum(long, F.lit(0)).cast("long") + 8 * len(columns)), F.lit(0))).first()
    buckets = max(1, -(-n // bucket_rows), -(-held // bucket_bytes))
    # pass 1: scatter
    bucket = F.pmod(F.xxhash64(F.lit(seed), *columns, "__copy"), F.lit(buckets)).cast("long")
    scattered = copies.withColumn("__bucket", bucket)
    # pass 2: a fixed order inside the bucket, then Fisher-Yates
    gathered = (scattered.repartition(min(buckets, PARTITIONS), "__bucket").groupBy("__bucket")
                .agg(F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 1), *columns, "__copy").alias("__h"),
                                                          "__copy", *columns))).alias("__rows"))
                .sortWithinPartitions("__bucket"))
    dealt = stage(gathered.select("__bucket", F.posexplode(F.shuffle("__rows", seed)).alias("__at", "__row"))
                  .select("__bucket", "__at", *[F.col("__row")[c].alias(c) for c in columns]), "shuffle")
    sizes = dealt.groupBy("__bucket").agg(F.count("*").alias("__size"))
    return dealt.join(_offsets(sizes), "__bucket").withColumn("__position", F.col("__offset") + F.col("__at")).drop("__bucket", "__at", "__offset")


def _offsets(sizes: DataFrame, group: int = 4096) -> DataFrame:
    """``__bucket, __offset``: rows in all buckets before.  Prefix sums in groups
    of buckets, then over the groups: with b buckets no window sees more than
    ``group`` or b / group rows."""
    grouped = sizes.withColumn("__group", (F.col("__bucket") / group).cast("long"))
    totals = grouped.groupBy("__group").agg(F.sum("__size").alias("__total"))
    before = Window.partitionBy(F.lit(0)).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__group", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (grouped.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
            .join(starts, "__group").select("__bucket", (F.col("__start") + F.col("__inside")).alias("__offset")))


def assign_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``."""
    placed = shuffle_rows(rows, seed, bucket_rows)
    return (placed.withColumn("shard", F.pmod("__position", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("__position") / shards).cast("long")).drop("__position"))


def write_shards(rows: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> None:
    """Write the shuffled rows, whole, one folder per shard and in slot order within a
    file.  A shard is written in pieces of ``PIECE_ROWS`` slots, so there are as many
    tasks as pieces and not only as shards."""
    placed = assign_shards(rows, shards, seed, bucket_rows).withColumn("__piece", F.floor(F.col("slot") / PIECE_ROWS))
    (placed.repartition("shard", "__piece").sortWithinPartitions("shard", "slot").drop("__piece")
     .write.partitionBy("shard").parquet(path))


def op9_sharding(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document under the law ``rows``."""
    rows = documents.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                            F.crc32(F.encode("text", "UTF-8")).cast("long").alias("text_crc32"))
    return (assign_shards(rows, shards)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))
