"""Sharding by balanced label propagation, in DataFrame operations only.

Documents are linked through hubs (here: equal texts), so a group of n copies
is n links, not n^2 edges. Labels start as a hash of the id. In each round a
document counts how many of its hub mates are in each shard and proposes to
move to the shard with most of them that still has room; proposals are
accepted hub by hub within the shards' quotas. A hub with more members than a
shard holds is split into salted parts first. When no proposal is left,
the shards are made even to the row: surplus rows, unlinked ones first, move
from full to open shards. Ranks are two-level (hash buckets, then rows within a
bucket), so no task sees a whole shard.

Law ``rows``: shard counts differ by one at most. Defined results: NULL texts
have no hub and size 1; repeated rows are separate rows with their own
slots; NULL ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import documents, stored

SHARDS = 16
MAX_ROUNDS = 6
BUCKET_ROWS = 50_000
LAW = "rows"


def _sums(cond: Column, n: int) -> list[Column]:
    return [F.sum(F.when(cond == s, 1).otherwise(0)).alias(f"c{s}") for s in range(n)]


def propagate(links: DataFrame, quota: int, shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Labels for linked rows: ``links`` is (row, hub), every hub with two rows at least.

    Returns (row, shard, affinity): hub mates in the row's own shard.
    """
    # a hub larger than a shard is dealt into parts that fit
    degree = links.groupBy("hub").agg(F.count(F.lit(1)).alias("_d"))
    parts = F.ceil(F.col("_d") / F.lit(max(1, quota * 9 // 10)))
    links = stored(links.join(degree, "hub").select("row", F.xxhash64("hub", F.pmod(F.xxhash64("row"), parts)).alias("hub"))
                   .distinct(), "shard-links")
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    labels = stored(links.groupBy("row").agg(F.min("hub").alias("key")).withColumn("shard", shard), "shard-labels")
    names = [f"c{s}" for s in range(shards)]
    affinity = None
    for turn in range(rounds + 1):
        by_hub = (links.join(labels, "row").groupBy("hub").agg(*_sums(F.col("shard"), shards),
                                                              F.count(F.lit(1)).alias("members")))
        by_row = (links.join(by_hub, "hub").groupBy("row")
                  .agg(*[F.sum(c).alias(c) for c in names], F.max("members").alias("members")))
        affinity = labels.join(by_row, "row")
        own = F.element_at(F.array(*names), F.col("shard") + 1)
        if turn == rounds:
            break
        held = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = [quota - held.get(s, 0) for s in range(shards)]
        # most mates first; among equals an order of shards that depends on the row's first hub
        options = [F.struct(F.when(F.col(f"c{s}") + room[s] >= F.col("members"), F.col(f"c{s}")).otherwise(-1).alias("n"),
                            F.xxhash64("key", F.lit(s)).alias("t"), F.lit(s).alias("s")) for s in range(shards)]
        wish = stored(affinity.select("row", "key", "shard", own.alias("own"), F.array_max(F.array(*options)).alias("best"))
                      .select("row", "key", "shard", F.when((F.col("best.n") >= F.col("own")) & (F.col("best.n") > 0),
                                                            F.col("best.s")).otherwise(F.col("shard")).alias("wish")),
                      "shard-wishes")
        flows = wish.where("wish <> shard").groupBy("shard", "wish").agg(F.count(F.lit(1)).alias("n")).collect()
        if not flows:
            break
        into, out = [0] * shards, [0] * shards
        for f in flows:
            into[f["wish"]] += f["n"]
            out[f["shard"]] += f["n"]
        # share of the proposals into each shard that its quota takes
        share = [min(1.0, max(0, room[s] + out[s] // 2) / into[s]) if into[s] else 1.0 for s in range(shards)]
        limit = F.element_at(F.array(*[F.lit(int(x * 1_000_000)) for x in share]), F.col("wish") + 1)
        accept = F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(1_000_000)) < limit
        labels = stored(wish.select("row", "key", F.when(accept, F.col("wish")).otherwise(F.col("shard")).alias("shard")),
                        "shard-labels")
    return affinity.select("row", "shard", own.alias("affinity"))


def ranked(rows: DataFrame, group: str, bucket: Column, name: str) -> DataFrame:
    """Adds ``name``: a gapless rank from 0 within ``group``, by bucket, then by hash of the row."""
    rows = rows.withColumn("_b", bucket)
    counts = rows.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(group, "_b", (F.sum("_n").over(Window.partitionBy(group).orderBy("_b")) - F.col("_n"))
                           .alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_b").orderBy(F.xxhash64("row"), "row"))
    return (rows.withColumn("_r", inside).join(before, [group, "_b"])
            .withColumn(name, F.col("_before") + F.col("_r") - 1).drop("_b", "_r", "_before"))


def balance(rows: DataFrame, total: int, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(row, shard, affinity, ...) with shards made even to the row, and ``slot``."""
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    held = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    spill = [max(0, held.get(s, 0) - quota[s]) for s in range(shards)]
    buckets = max(8, total // (shards * bucket_rows))
    lookup = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)
    # unlinked rows leave first, then members of small hubs
    order = F.least(F.ceil(F.log2(F.col("affinity") + 1)), F.lit(40)) * buckets + F.pmod(F.xxhash64("row"), F.lit(buckets))
    placed = ranked(rows, "shard", order.cast("long"), "_leave")
    # surplus rows are numbered over all shards and dealt to the open places in turn
    first = [sum(spill[:s]) for s in range(shards)]
    edges, at = [], 0
    for s in range(shards):
        gap = max(0, quota[s] - held.get(s, 0))
        if gap:
            at += gap
            edges.append((at, s))
    number = F.col("_leave") + lookup(first)
    target = F.lit(None).cast("int")
    for end, s in reversed(edges):
        target = F.when(number < end, F.lit(s)).otherwise(target)
    moved = placed.withColumn("shard", F.when(F.col("_leave") < lookup(spill), target).otherwise(F.col("shard"))
                              .cast("int")).drop("_leave")
    return ranked(moved, "shard", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(buckets)), "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Every row of (doc_id, text) in one shard, copies of a text together as far as quotas allow."""
    text = F.col("text").cast("string")
    nodes = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(F.md5(text.cast("binary")))).alias("hub")), "shard-nodes")
    total = nodes.count()
    # the hash is computed from the written row number, so it stays the same when a task is run again
    copies = nodes.where("hub is not null").groupBy("hub").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("hub")
    links = nodes.select("row", "hub").join(copies, "hub").select("row", "hub")
    labels = propagate(links, max(1, total // shards), shards, rounds)
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    labelled = stored(nodes.drop("hub").join(labels, "row", "left").select(
        "row", "doc_id", "size", "text_crc32", F.coalesce("shard", start).alias("shard"),
        F.coalesce("affinity", F.lit(0)).alias("affinity")), "shard-rows")
    return balance(labelled, total, shards)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``rows``."""
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "affinity")
