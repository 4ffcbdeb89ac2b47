"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring at many places, its virtual nodes. A row belongs to the first shard
that stands clockwise of the hash of its id. Loads are bounded: a shard takes its capacity and no
more, and rows that find it full continue clockwise to the next shard that has room. With no slack
the capacities are the row counts split evenly, so counts are at most one apart (law ``rows``), and
only rows next to full shards stand elsewhere than on the plain ring.

The ring is cut into ``ARCS`` equal arcs. Rows are first counted per arc, a table of bounded size;
on it the walk is planned in one round per shard: every arc's unplaced rows ask the next shard of
their clockwise order, shards accept in ring order until they are full. An arc that a shard can
take only in part is split by rank. Rows then get their rank in their arc, and rank and plan give
shard and slot. Only built-in functions run; the text is read once, for its size and checksum.

Null ids have one hash and so one arc; ranks split it like any other. Null texts have no bytes.
Repeated rows are placed each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linksieve.llm.texts import column
from linksieve.session import checkpointed

SHARDS = 8
#: Places of each shard on the ring, and arcs of the ring (a power of 16).
VIRTUAL_NODES = 128
ARCS = 16**4


def _arc(value: Column) -> Column:
    """The arc of a value: the first hexadecimal digits of its md5."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 4)
    return F.conv(digits, 16, 10).cast("int")


def ring(spark, shards: int = SHARDS) -> DataFrame:
    """For every arc, all shards in clockwise order: ``arc, walk``."""
    nodes = spark.range(shards * VIRTUAL_NODES).select(
        _arc(F.concat(F.lit("node-"), F.col("id"))).alias("arc"), (F.col("id") % shards).cast("int").alias("node")
    )
    arcs = spark.range(ARCS).select(F.col("id").cast("int").alias("arc"), F.lit(None).cast("int").alias("node"))
    # twice round, so that the next place of a shard is found by looking ahead
    places = nodes.unionByName(nodes.withColumn("arc", F.col("arc") + ARCS)).unionByName(arcs)
    ahead = Window.orderBy(F.col("arc").desc(), F.col("node").asc_nulls_last())
    found = [F.last(F.when(F.col("node") == s, F.col("arc")), ignorenulls=True).over(ahead) for s in range(shards)]
    steps = [F.struct((place - F.col("arc")).alias("steps"), F.lit(s).alias("shard")) for s, place in enumerate(found)]
    walk = F.transform(F.array_sort(F.array(*steps)), lambda x: x["shard"])
    return places.select("arc", "node", walk.alias("walk")).filter("node IS NULL").select("arc", "walk")


def walk_plan(counts: DataFrame, shards: int = SHARDS, slack: float = 0.0) -> DataFrame:
    """Pieces of arcs: ``arc, first, n`` (ranks in the arc), ``shard`` and ``slot`` of the first.

    ``counts`` has ``arc`` and ``n``, one row per arc at most.
    """
    total = F.coalesce(F.sum("n").over(Window.partitionBy()), F.lit(0))
    room = [
        F.floor(total / shards * (1 + slack)).cast("long") + (F.lit(s) < total % shards).cast("long")
        for s in range(shards)
    ]
    pieces = (
        counts.join(F.broadcast(ring(counts.sparkSession, shards)), "arc")  # ARCS rows
        .withColumn("room", F.array(*room))
        .withColumn("first", F.lit(0).cast("long"))
        .withColumn("shard", F.lit(None).cast("int"))
    )
    for step in range(shards):
        asked = F.coalesce("shard", F.col("walk")[step])
        order = Window.partitionBy("asked").orderBy(F.col("shard").isNull(), "arc", "first")
        before = F.sum("n").over(order) - F.col("n")
        taken = F.greatest(F.lit(0), F.least(F.col("n"), F.element_at("room", F.col("asked") + 1) - before))
        parts = F.array(
            F.struct(F.col("first"), F.col("taken").alias("n"), F.col("asked").alias("shard")),
            F.struct(
                (F.col("first") + F.col("taken")).alias("first"),
                (F.col("n") - F.col("taken")).alias("n"),
                F.lit(None).cast("int").alias("shard"),
            ),
        )
        pieces = (
            pieces.withColumn("asked", asked)
            .withColumn("taken", taken)
            .withColumn("part", F.explode(F.filter(parts, lambda p: p["n"] > 0)))
            .select("arc", "walk", "room", "part.first", "part.n", "part.shard")
        )
    slots = Window.partitionBy("shard").orderBy("arc", "first")
    return pieces.select("arc", "first", "n", "shard", (F.sum("n").over(slots) - F.col("n")).alias("slot"))


def shard_rows(df: DataFrame, text: str = "text", key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``df``."""
    raw = F.encode(F.coalesce(column(text), F.lit("")), "UTF-8")
    rows = checkpointed(
        df.select(
            column(key).alias("\x00key"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            _arc(column(key)).alias("arc"),
        )
    )
    plan = walk_plan(rows.groupBy("arc").agg(F.count("*").alias("n")), shards)
    pieces = plan.groupBy("arc").agg(F.collect_list(F.struct("first", "n", "shard", "slot")).alias("pieces"))
    rank = F.row_number().over(Window.partitionBy("arc").orderBy("\x00key", "text_crc32", "size")) - 1
    own = F.filter("pieces", lambda p: (F.col("rank") >= p["first"]) & (F.col("rank") < p["first"] + p["n"]))[0]
    return (
        rows.withColumn("rank", rank)
        .join(F.broadcast(pieces), "arc")  # ARCS rows, shards pieces each at most
        .withColumn("own", own)
        .select(
            column("\x00key").alias(key),
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("own.shard").alias("shard"),
            (F.col("own.slot") + F.col("rank") - F.col("own.first")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
