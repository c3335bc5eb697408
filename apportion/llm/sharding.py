"""Sharding over fixed virtual slots.

Records hash into ``n_slots`` virtual slots, never changed afterwards. The
bytes and rows of each slot are aggregated, and a versioned map says which
shard owns which slot. Rebalancing edits the map (a new version, as few moved
slots as possible); no record is rehashed. The slot table has ``n_slots`` rows
whatever the data, so it is planned on the driver and broadcast.

A null ``doc_id`` or text hashes like any other value. Repeated rows (one
``doc_id``, text checksum and size) are counted and numbered; the first has the
slot of a single row, each further one hashes with its number, so that they
spread over the slots and the shards stay even. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apportion.llm.common import shared_folder

N_SLOTS = 8192
ROW_OVERHEAD = 16
#: Repeated rows that one row of the counted table stands for at most, before they are dealt and numbered.
COPIES = 4096


@dataclass(frozen=True)
class SlotMap:
    """Version and owner of each virtual slot (index = slot)."""

    version: int
    owner: tuple[int, ...]
    n_shards: int

    def save(self, spark: SparkSession, path: str) -> None:
        """Store this version beside the earlier ones."""
        rows = [(slot, shard) for slot, shard in enumerate(self.owner)]
        spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/n_shards={self.n_shards}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, n_shards: int, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/n_shards={n_shards}/version={version}").orderBy("virtual_slot").collect()
        return SlotMap(version, tuple(r.shard for r in rows), n_shards)


def even_map(n_slots: int, n_shards: int) -> SlotMap:
    """Version 0: the same number of slots for each shard, before any bytes are known."""
    return SlotMap(0, tuple(slot % n_shards for slot in range(n_slots)), n_shards)


def rebalance(old: SlotMap, slot_bytes: dict[int, int]) -> SlotMap:
    """The next version: slots move from the fullest to the emptiest shard while that narrows their difference."""
    held: list[list[tuple[int, int]]] = [[] for _ in range(old.n_shards)]
    for slot, shard in enumerate(old.owner):
        if slot_bytes.get(slot, 0):
            held[shard].append((slot_bytes[slot], slot))
    total = [sum(b for b, _ in x) for x in held]
    owner = list(old.owner)
    for _ in range(4 * len(owner)):
        high = max(range(old.n_shards), key=lambda s: (total[s], -s))
        low = min(range(old.n_shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        best = min(((abs(gap - 2 * b), slot, b) for b, slot in held[high] if b < gap), default=None)
        if best is None or best[0] >= gap:
            break
        _, slot, size = best
        held[high].remove((size, slot))
        held[low].append((size, slot))
        total[high] -= size
        total[low] += size
        owner[slot] = low
    return SlotMap(old.version + 1, tuple(owner), old.n_shards)


def grow(old: SlotMap, slot_bytes: dict[int, int]) -> SlotMap:
    """The next version with one shard more, which takes slots from the fullest shards; no other slot moves."""
    n = old.n_shards + 1
    total = [0] * n
    held: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for slot, shard in enumerate(old.owner):
        held[shard].append((slot_bytes.get(slot, 0), slot))
        total[shard] += slot_bytes.get(slot, 0)
    owner, goal = list(old.owner), sum(total) / n
    for x in held:
        x.sort()
    while total[-1] < goal:
        high = max(range(n - 1), key=lambda s: (total[s], -s))
        if not held[high] or not held[high][-1][0]:
            break
        size, slot = held[high].pop()
        if total[-1] + size > goal + size / 2:
            break
        total[high] -= size
        total[-1] += size
        owner[slot] = n - 1
    return SlotMap(old.version + 1, tuple(owner), n)


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, number among equal rows (from 0) and the fixed virtual slot of each record."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    record = ["doc_id", "text_crc32", "size"]
    counted = rows.groupBy(*record).agg(F.count("*").alias("n"))  # combined in each map task
    some = counted.select(*record, "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")).alias("some")).repartition(*record, "some")
    each = some.select(*record, F.explode(F.expr(f"sequence(some * {COPIES}, least(n, (some + 1) * {COPIES}) - 1)")).alias("copy"))
    hashed = F.when(F.col("copy") == 0, F.xxhash64(*record)).otherwise(F.xxhash64(*record, "copy"))
    return each.select("doc_id", "size", "text_crc32", "copy", F.pmod(hashed, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def shard_by_slots(docs: DataFrame, n_shards: int = 40, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Documents with their shard and their place in it, shard bytes near equal.

    Both map versions are stored below ``map_path`` (default: a new folder in
    the shared one); the rows follow the stored newest version.
    """
    spark = docs.sparkSession
    rows = slotted(docs, n_slots)
    sizes = {r.virtual_slot: r for r in slot_sizes(rows).collect()}  # n_slots rows at most
    path = map_path or shared_folder(spark, "slot-map")
    first = even_map(n_slots, n_shards)
    first.save(spark, path)
    rebalance(first, {k: r.bytes for k, r in sizes.items()}).save(spark, path)
    stored = SlotMap.load(spark, path, n_shards, first.version + 1)

    before = [0] * n_shards  # rows of the shard's earlier slots: a slot's first place
    owners = []
    for slot, shard in enumerate(stored.owner):
        owners.append((slot, shard, before[shard]))
        before[shard] += sizes[slot].rows if slot in sizes else 0
    owned = spark.createDataFrame(owners, "virtual_slot int, shard int, first_place long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy"))
    return (
        rows.withColumn("place", place)
        .join(F.broadcast(owned), "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first_place") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot", F.lit(stored.version).alias("map_version"),
        )
    )
