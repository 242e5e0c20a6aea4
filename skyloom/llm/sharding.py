"""Shards by fixed virtual slots: records hash into slots, a versioned map says which shard holds a slot."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import written
from skyloom.session import scratch

SLOTS = 4096
ROW_BYTES = 16
RUN = 4096


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size in bytes, text_crc32 and virtual slot of each row; a null text has no bytes.

    The slot comes from a hash of id and text, so copies of a text with ids of their own spread over all slots.
    Rows equal in both are counted first and take one slot after the other, in runs that are dealt out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spread = F.xxhash64("doc_id", "text")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        spread.alias("spread"),
    )
    equal = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN)))
    runs = equal.withColumn("run", run).repartition("spread", "run")
    nth = F.explode(F.sequence(F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, "n") - 1))
    slot = F.pmod(F.pmod("spread", F.lit(slots)) + F.col("nth"), F.lit(slots)).cast("int")
    return runs.withColumn("nth", nth).select("doc_id", "size", "text_crc32", slot.alias("virtual_slot"), "spread")


def slot_sizes(placed: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot; partial sums are formed before the shuffle."""
    return placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(spark, slots: int, shards: int) -> DataFrame:
    """Version 0 of a map: slots dealt to shards in turn, whatever they hold."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(
        slot.alias("virtual_slot"), F.pmod(slot, F.lit(shards)).alias("shard"), F.lit(0).alias("version")
    )


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, with nearly equal bytes in each shard.

    A shard keeps its largest slots as long as their sum stays within the mean; only what is beyond is given up,
    and the given-up slots go, largest first, to the shard that holds least.  The fold over the
    slots is one row, as a map has a fixed number of slots however large the data is.
    """
    held = slot_map.join(sizes, "virtual_slot", "left").select(
        "virtual_slot", "shard", "version", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )
    mean = held.select((F.sum("bytes").over(Window.partitionBy(F.lit(1))) / F.lit(shards)).alias("mean"), "*")
    upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    judged = mean.withColumn("stays", F.sum("bytes").over(upto) <= F.col("mean"))
    moved = F.array_sort(
        F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), F.col("virtual_slot").alias("slot"))))
    )
    kept = F.filter(F.collect_list(F.when(F.col("stays"), F.struct("virtual_slot", "shard", "bytes"))), lambda x: x.isNotNull())
    one = judged.agg(moved.alias("moved"), kept.alias("kept"), F.max("version").alias("version"))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(F.filter("kept", lambda k: k.shard == s), F.lit(0).cast("long"), lambda a, k: a + k.bytes),
    )
    start = F.struct(loads.alias("loads"), F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("done"))

    def place(state, item):
        least = F.array_position(state.loads, F.array_min(state.loads)).cast("int") - 1
        return F.struct(
            F.transform(state.loads, lambda x, i: F.when(i == least, x - item.less).otherwise(x)).alias("loads"),
            F.concat(state.done, F.array(F.struct(item.slot.alias("virtual_slot"), least.alias("shard")))).alias("done"),
        )

    stay = F.transform("kept", lambda k: F.struct(k.virtual_slot.alias("virtual_slot"), k.shard.alias("shard")))
    every = F.concat(stay, F.aggregate("moved", start, place, lambda s: s.done))
    return one.select(F.explode(every).alias("e"), (F.col("version") + 1).alias("version")).select("e.virtual_slot", "e.shard", "version")


def grown(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map with one more shard, numbered ``shards``, which alone receives slots."""
    held = slot_map.join(sizes, "virtual_slot", "left").select(
        "virtual_slot", "shard", "version", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(1))) / F.lit(shards + 1)
    upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    judged = held.withColumn("mean", mean).withColumn("stays", F.sum("bytes").over(upto) <= F.col("mean"))
    return judged.select(
        "virtual_slot", F.when(F.col("stays"), F.col("shard")).otherwise(F.lit(shards)).alias("shard"), (F.col("version") + 1).alias("version")
    )


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into a shard so that the shards' bytes are near equal.

    Bytes are summed by virtual slot, version 0 of the map is edited by them, both versions are stored in the
    shared folder, and the last one is read back and joined.  ``slot`` is the row's place in its shard, from 0 without gaps: rows before
    its virtual slot, by sums of slots, and rows before it inside the slot.  Rows that are equal in
    id and text take one virtual slot after the other; a null text counts 16 bytes; an empty table gives an empty one; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    placed = written(records(docs, slots), "records")
    sizes = written(slot_sizes(placed), "slots")
    store = scratch(spark, "slot-map")
    first = first_map(spark, slots, shards)
    first.write.mode("append").partitionBy("version").parquet(store)
    rebalanced(first, sizes, shards).write.mode("append").partitionBy("version").parquet(store)
    current = spark.read.schema("virtual_slot int, shard int, version int").parquet(store).where("version = 1")
    # One row per virtual slot, so the map is small whatever the data: broadcasting it is safe.
    at = placed.join(F.broadcast(current), "virtual_slot")
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = current.join(sizes, "virtual_slot").select(
        "virtual_slot", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).cast("long").alias("base")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("spread", "doc_id", "size", "text_crc32")
    return (
        at.join(F.broadcast(bases), "virtual_slot")
        .withColumn("slot", F.col("base") + F.row_number().over(inside) - 1)
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
        )
    )
