"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns ``NODES`` points of a ring, placed by a hash of (shard, replica), so a further shard adds points
and moves none. A row's key is hashed to a place on the ring; the arc between two points belongs to the point at
its clockwise end. Rows are taken in ring order (arc, place, id, checksum, size). A row goes to its arc's shard while
that has room, else clockwise to the next shard with room. All rows of an arc have the same way round the ring, so the
walk needs only the number of rows per arc: it is a fold over the ring's points, however many rows there are, and says
for each arc at which of its rows the next shard begins.

A row's number within its arc comes from one range-partitioned sort of narrow rows (id, size, checksum, place; no
texts). A row number taken when the rows are first written is the last sort key, so one key with a third of all rows,
or as many equal rows, is split over partitions like any other; equal rows are interchangeable in the result. Each
pass is written to the shared folder, so numbers stay the same when an executor is lost.

Laws: ``rows`` gives every shard floor(n / shards) or one more of the n rows (the bound is exact and shards of smaller number
take the remainder); with ``slack`` > 0 a shard takes up to ceil((1 + slack) * n / shards) rows, counts may differ, fewer rows leave their
own shard and the law is called ``bounded``. ``key`` has no bound: id and shard count decide alone, and
``grown_shard`` is the shard with one shard more.

Null texts have no bytes (size 1, checksum 0); a null id is a key of its own; repeated rows are rows each; an empty
table gives an empty result; columns not named in ``keep`` are dropped, and names of the result win over theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise, text_col

NODES = 128        # points of a shard
RING_BITS = 60     # places on the ring
OWN = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def place(text: Column) -> Column:
    """Place of a key on the ring: the first 15 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """``(arc, point, shard)``: the points of all shards in clockwise order; shards * nodes rows."""
    points = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        place(F.concat(F.lit("node:"), (F.col("id") % shards).cast("string"), F.lit(":"),
                       F.floor(F.col("id") / shards).cast("string"))).alias("point"))
    return points.withColumn("arc", F.row_number().over(Window.orderBy("point", "shard")) - 1)


def _cells(points: DataFrame, bits: int) -> DataFrame:
    """The ring cut in 2**bits equal cells: points before each, and those inside."""
    inside = (points.groupBy(F.shiftright("point", RING_BITS - bits).alias("cell"))
              .agg(F.sort_array(F.collect_list("point")).alias("inside")))
    cells = points.sparkSession.range(2 ** bits).withColumnRenamed("id", "cell").join(inside, "cell", "left")
    size = F.coalesce(F.size("inside"), F.lit(0))
    before = F.sum(F.when(F.col("inside").isNull(), 0).otherwise(size)).over(Window.orderBy("cell"))
    return cells.select("cell", F.coalesce("inside", F.array().cast("array<bigint>")).alias("inside"),
                        (before - F.when(F.col("inside").isNull(), 0).otherwise(size)).alias("before"))


def with_arc(rows: DataFrame, points: DataFrame, shards: int, nodes: int, name: str) -> DataFrame:
    """Column ``name``: the arc of column ``place``. The cells broadcast are bounded by the ring, not by the rows."""
    total = shards * nodes
    bits = max(1, (4 * total - 1).bit_length())
    at = F.col("before") + F.size(F.filter("inside", lambda x: x < F.col("place")))
    return (rows.withColumn("cell", F.shiftright("place", RING_BITS - bits))
            .join(F.broadcast(_cells(points, bits)), "cell")
            .withColumn(name, (at % total).cast("int")).drop("cell", "inside", "before"))


def _walk(points: DataFrame, counts: DataFrame, shards: int, slack: float | None) -> DataFrame:
    """``(arc, start, cuts)`` for every arc with rows: the number of rows before it, and per shard that its rows go to
    the arc's row at which the next shard begins, the shard, and what to add to a row's number for its slot."""
    arcs = points.join(counts, "arc", "left").select(
        "arc", "shard", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    one = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "n"))).alias("arcs"), F.sum("n").alias("rows"))
    if slack is None:
        room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.col("rows"))
    elif slack == 0:
        room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                           lambda s: F.floor(F.col("rows") / shards) + F.when(s < F.col("rows") % shards, 1).otherwise(0))
    else:
        room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                           lambda s: F.ceil(F.col("rows") * F.lit(1.0 + slack) / shards))
    one = one.select("arcs", "rows", room.alias("room"),
                     F.concat(F.transform("arcs", lambda a: a["shard"]), F.transform("arcs", lambda a: a["shard"])).alias("round"))
    cut = "array<struct<arc:int,start:bigint,upto:bigint,shard:int,add:bigint>>"
    zeros = F.transform(F.col("room"), lambda r: F.lit(0).cast("long"))

    def step(state: Column, arc: Column) -> Column:
        way = F.array_distinct(F.slice(F.col("round"), arc["arc"] + 1, F.size("arcs")))

        def visit(s: Column, shard: Column) -> Column:
            load = F.get(s["load"], shard)
            take = F.least(arc["n"] - s["done"], F.get(F.col("room"), shard) - load)
            more = F.array(F.struct(arc["arc"].alias("arc"), state["start"].alias("start"), (s["done"] + take).alias("upto"),
                                    shard.alias("shard"), (load - s["done"]).alias("add"))).cast(cut)
            return F.when(take <= 0, s).otherwise(F.struct(
                F.transform(s["load"], lambda v, i: v + F.when(i == shard, take).otherwise(0)).alias("load"),
                (s["done"] + take).alias("done"), F.concat(s["cuts"], more).alias("cuts")))

        went = F.aggregate(way, F.struct(state["load"].alias("load"), F.lit(0).cast("long").alias("done"),
                                         F.array().cast(cut).alias("cuts")), visit)
        return F.when(arc["n"] == 0, state).otherwise(F.struct(
            went["load"].alias("load"), (state["start"] + arc["n"]).alias("start"),
            F.concat(state["cuts"], went["cuts"]).alias("cuts")))

    walked = F.aggregate(F.col("arcs"), F.struct(zeros.alias("load"), F.lit(0).cast("long").alias("start"),
                                                 F.array().cast(cut).alias("cuts")), step, lambda s: s["cuts"])
    return (one.select(F.inline(walked)).groupBy("arc", "start")
            .agg(F.sort_array(F.collect_list(F.struct("upto", "shard", "add"))).alias("cuts")))


def assign(docs: DataFrame, shards: int = 16, law: str = "rows", slack: float = 0.0, nodes: int = NODES,
           key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with size, text_crc32, law, shard, slot (gapless from 0 in a shard) and
    grown_shard (law ``key``)."""
    if law not in ("rows", "key") or shards < 1 or nodes < 1 or slack < 0:
        raise ValueError("law is rows or key, with at least one shard and node and slack of at least 0")
    spark = docs.sparkSession
    whole = text_col(text)
    name = F.coalesce(F.concat(F.lit("id:"), F.col(key).cast("string")), F.lit("null"))
    narrow = materialise(docs.select(
        F.struct(*[c for c in keep if c not in OWN]).alias("kept"), F.col(key).alias("ring_key"), place(name).alias("place"),
        (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row")), "ring-rows")
    points = ring(spark, shards, nodes)
    order = ["arc", "place", "ring_key", "text_crc32", "size", "row"]
    spread = (with_arc(narrow, points, shards, nodes, "arc").repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id())
              .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    spread = materialise(spread, "ring-order")
    cuts = _walk(points, spread.groupBy("arc").agg(F.count(F.lit(1)).alias("n")), shards, None if law == "key" else slack)
    sizes = spread.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sort, and one per arc: neither grows with the rows
    offsets = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    numbered = spread.join(F.broadcast(offsets), "part").join(F.broadcast(cuts), "arc")
    numbered = numbered.withColumn("n", F.col("offset") + F.col("at") - F.col("start"))
    mine = F.filter("cuts", lambda c: F.col("n") < c["upto"])
    numbered = numbered.withColumn("cut", F.get(mine, F.lit(0)))
    grown = F.lit(None).cast("int")
    if law == "key":
        more = ring(spark, shards + 1, nodes)
        numbered = (with_arc(numbered, more, shards + 1, nodes, "grown_arc")
                    .join(F.broadcast(more.select(F.col("arc").alias("grown_arc"), F.col("shard").alias("grown"))), "grown_arc"))
        grown = F.col("grown")
    return numbered.select(
        "kept.*", "size", "text_crc32",
        F.lit("bounded" if law == "rows" and slack > 0 else law).alias("law"), F.col("cut.shard").alias("shard"),
        (F.col("n") + F.col("cut.add")).alias("slot"), grown.alias("grown_shard"))
