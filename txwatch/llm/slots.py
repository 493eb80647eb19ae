"""Sharding over fixed virtual slots (DataFrame functions only).

A record's key (all that tells it apart) hashes into one of a fixed number of slots. Bytes are summed per slot, and a versioned table
maps slots to shards. Placing a record needs only its slot and the table; rebalancing writes a new version in
which as few slots as possible have moved. The table has `slots` rows at every size of the corpus, so it may
be collected and broadcast.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.session import materialise, scratch_path

SLOTS = 4096
RUN = 1024
MAP_SCHEMA = "version int, slot int, shard int, n_rows long, n_bytes long"


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 32 bits of the MD5 of its parts' text. A null part counts as an empty text."""
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(k.cast("string"), F.lit("")) for k in key]).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def slot_loads(records: DataFrame) -> DataFrame:
    """Rows and bytes per slot of (vslot, size) rows: combined before the shuffle, at most `slots` rows."""
    return records.groupBy("vslot").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"))


def _loads(loads: DataFrame, slots: int) -> list[tuple[int, int]]:
    got = {r["vslot"]: (r["n_rows"], r["n_bytes"]) for r in loads.collect()}  # at most `slots` rows
    return [got.get(s, (0, 0)) for s in range(slots)]


def first_map(spark: SparkSession, loads: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots from the heaviest down, each to the shard with the fewest bytes so far."""
    weight = _loads(loads, slots)
    heap = [(0, shard) for shard in range(shards)]
    rows = []
    for s in sorted(range(slots), key=lambda s: (-weight[s][1], s)):
        total, shard = heapq.heappop(heap)
        heapq.heappush(heap, (total + weight[s][1], shard))
        rows.append((1, s, shard, *weight[s]))
    return spark.createDataFrame(rows, MAP_SCHEMA)


def rebalanced(spark: SparkSession, current: DataFrame, loads: DataFrame, shards: int, slack: float = 0.01) -> DataFrame:
    """The next version for `shards` shards and new loads.

    Slots of shards that no longer exist move first. Then the fullest shard gives its largest slot that fits
    the gap to the emptiest one, until no shard is more than `slack` above the mean or no move helps.
    """
    old = sorted(current.collect(), key=lambda r: r["slot"])  # one row per slot
    slots, version = len(old), old[0]["version"] + 1
    weight = _loads(loads, slots)
    place = [r["shard"] for r in old]
    total = [0] * shards
    owned: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for s in range(slots):
        if place[s] < shards:
            total[place[s]] += weight[s][1]
            owned[place[s]].append(s)
        else:
            homeless.append(s)

    def move(s: int, to: int) -> None:
        place[s] = to
        total[to] += weight[s][1]
        owned[to].append(s)

    for s in sorted(homeless, key=lambda s: (-weight[s][1], s)):
        move(s, min(range(shards), key=lambda k: (total[k], k)))
    mean = sum(total) / shards
    while True:
        full = max(range(shards), key=lambda k: (total[k], -k))
        empty = min(range(shards), key=lambda k: (total[k], k))
        fits = [s for s in owned[full] if 0 < weight[s][1] < total[full] - total[empty]]
        if total[full] <= mean * (1 + slack) or not fits:
            break
        half = (total[full] - total[empty]) / 2
        s = min(fits, key=lambda s: (abs(weight[s][1] - half), s))
        owned[full].remove(s)
        total[full] -= weight[s][1]
        move(s, empty)
    return spark.createDataFrame([(version, s, place[s], *weight[s]) for s in range(slots)], MAP_SCHEMA)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Append a version to the table at `path`; earlier versions stay readable."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the newest by default."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds `shard` and `slot`, the record's gapless place in its shard, to (doc_id, size, vslot, ...) rows.

    Places follow the virtual slots and, inside one, the order of doc_id. Only one slot's narrow rows meet
    in a task; the offsets of slots in their shard come from the small map.
    """
    from pyspark.sql import Window

    by_slot = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.select(
        F.col("slot").alias("vslot"), "shard", "version", F.coalesce(F.sum("n_rows").over(by_slot), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(offsets), "vslot")
        .withColumn("slot", F.col("offset") + F.col("nth") - 1)
        .drop("nth", "offset")
    )


def copies_numbered(rows: DataFrame) -> DataFrame:
    """All of `rows` with `copy`, the row's place (0, 1, ...) among rows equal to it.

    Equal rows are counted, combined before the shuffle, and spelled out again in runs of at most RUN rows that
    are dealt out evenly, so that no task makes all copies of one row.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    last_run = F.floor((F.col("copies") - 1) / RUN)
    runs = counted.select(*names, "copies", F.explode(F.sequence(F.lit(0).cast("long"), last_run)).alias("run"))
    last = F.least(F.col("copies"), (F.col("run") + 1) * RUN) - 1
    return runs.repartition(*names, "run").select(*names, F.explode(F.sequence(F.col("run") * RUN, last)).alias("copy"))


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its size, shard and place; byte totals per shard are near equal.

    The map is stored as version 1 at `map_path` (a scratch folder if none is given) and read back. A null
    text has size 1 and checksum 0. The law is bytes, so a row's slot follows from its doc_id, size, checksum and
    place among equal rows: a null or repeated doc_id spreads over the slots, and the same rows get the same slots.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    records = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = [F.col(c) for c in ("doc_id", "size", "text_crc32", "copy")]
    records = copies_numbered(records).withColumn("vslot", slot_of(*key, slots=slots)).drop("copy")
    records = materialise(records, "shard-records")
    path = map_path or scratch_path(spark, "slot-map")
    save_map(first_map(spark, slot_loads(records), shards, slots), path)
    placed = assign(records, load_map(spark, path))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"),
        F.col("version").alias("map_version"),
    )
