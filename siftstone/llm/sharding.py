"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.runtime import materialize, table


@dataclass(frozen=True)
class Ring:
    """Virtual nodes of `shards` shards on a ring of `cells` equal cells; a cell belongs to the next node clockwise."""

    shards: int
    nodes: int = 128
    cells: int = 1 << 16

    def owners(self) -> list[tuple[int, int]]:
        """(cell where the arc ends, shard), clockwise; a cell that two nodes hit goes to the lower shard."""
        at: dict[int, int] = {}
        for shard in range(self.shards):
            for node in range(self.nodes):
                cell = int.from_bytes(hashlib.md5(f"{shard}/{node}".encode()).digest()[:8], "big") % self.cells
                at[cell] = min(shard, at.get(cell, shard))
        return sorted(at.items())


def plan(ring: Ring, counts: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """(cell, first rank, count, shard, first slot, home) of every run of keys.

    Room: floor(N / shards) each, one more for the first N mod shards. Every cell's keys first fill their own shard in
    ring order; keys beyond its room continue clockwise to the next node whose shard has room. So only
    sum(max(0, home load - room)) keys move, and counts differ by one at most. At most cells + nodes * shards runs.
    """
    total = sum(counts.values())
    room = [total // ring.shards + (s < total % ring.shards) for s in range(ring.shards)]
    used = [0] * ring.shards
    owners = ring.owners()
    ends = [c for c, _ in owners]
    runs, over = [], []
    for cell in sorted(counts):
        k = bisect.bisect_left(ends, cell) % len(ends)
        home = owners[k][1]
        stay = min(counts[cell], room[home] - used[home])
        if stay:
            runs.append((cell, 0, stay, home, used[home], home))
            used[home] += stay
        if stay < counts[cell]:
            over.append((cell, stay, counts[cell] - stay, k))
    for cell, rank, left, k in over:
        home = owners[k][1]
        while left:
            shard = owners[k % len(owners)][1]
            take = min(left, room[shard] - used[shard])
            if take:
                runs.append((cell, rank, take, shard, used[shard], home))
                used[shard] += take
                rank, left = rank + take, left - take
            k += 1
    return runs


def shard(spark: SparkSession, docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", nodes: int = 128, cells: int = 1 << 16) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    Law `rows`: shard counts are at most one apart. A row's place on the ring is a hash of its doc_id, so neither
    a hot source nor a group of copies shares a place, and an edited text stays; only rows of one doc_id share one. The driver sees one count a cell (65,536
    at most, whatever the input), plans runs of ranks, and rows meet their run by a broadcast equi-join on the cell.
    Ranks within a cell are by (doc_id, text_crc32), so results do not depend on partitions or retries.
    Null text: size 1, crc 0. Null doc_id: placed by its text alone. No rows: no rows.
    """
    ring = Ring(shards, nodes, cells)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("bigint") + 1).alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.pmod(F.coalesce(F.when(F.col(doc_id).isNotNull(), F.xxhash64(doc_id)), F.xxhash64(text)), F.lit(cells)).cast("int").alias("cell"))
    rows = materialize(spark, rows, "shard_rows")
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    schema = "cell int, first_rank bigint, many bigint, shard int, first_slot bigint, home_shard int"
    runs = F.broadcast(spark.createDataFrame(plan(ring, counts), schema))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")) - 1)
    placed = ranked.join(runs, "cell").where("rank >= first_rank and rank < first_rank + many")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("first_slot") + F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark, table(spark, sf_dir, "documents"))
