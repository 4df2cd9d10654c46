"""Sharding by Karmarkar-Karp differencing.

Documents with equal texts are one indivisible group. The differencing method starts with a partial
partition for each group (its size in one part, nothing in the others) and repeatedly takes the two
partial partitions with the largest spread, adding the parts of the one in descending order to
those of the other in ascending order, until one is left. Unfolding the merges gives each group's part.

Over many groups this runs as a tree. Cells of a bounded number of groups are differenced by separate
tasks; the parts of a cell are the indivisible items of the next level, a bounded number of items a
task again, until one task holds the last few. Groups so large that they weigh on the balance by
themselves skip the tree and enter at its root; there are fewer of them than shards times ``HEAVY``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stage

# A group of at least a HEAVYth of a shard's share enters at the root.
HEAVY = 64
# Least items of a cell for each part.
LEAST = 4
OVERHEAD = 16


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part, 0 to ``parts`` - 1, of each size, by differencing; ties by position.

    A partial partition holds its filled parts only, in descending order, so that many parts cost no memory
    before they are filled.
    """
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int32)
    sums = {i: np.array([size], dtype=np.int64) for i, size in enumerate(sizes)}
    heap = [(-int(size), i) if parts > 1 else (0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        one, other = sums.pop(a), sums.pop(b)[::-1]
        if len(one) + len(other) <= parts:
            total, places = np.concatenate([one, other]), np.r_[: len(one), parts - len(other) : parts]
        else:
            total, places = np.zeros(parts, dtype=np.int64), np.arange(parts)
            total[: len(one)] = one
            total[parts - len(other) :] += other
        order = np.argsort(-total, kind="stable")
        total = total[order]
        node = n + len(merges)
        merges.append((a, b, len(one), len(other), places[order].astype(np.int32)))
        sums[node] = total
        heapq.heappush(heap, (-int(total[0] - (total[-1] if len(total) == parts else 0)), node))
    # Unfold: labels[node][j] is the final part of the node's j-th largest part.
    top = heap[0][1]
    labels: dict[int, np.ndarray] = {top: np.arange(len(sums[top]), dtype=np.int32)}
    out = np.zeros(n, dtype=np.int32)
    for node in range(n + len(merges) - 1, -1, -1):
        own = labels.pop(node)
        if node < n:
            out[node] = own[0]
            continue
        a, b, filled, others, places = merges.pop()
        if filled + others <= parts:
            first = places < filled
            labels[a], labels[b] = np.empty(filled, np.int32), np.empty(others, np.int32)
            labels[a][places[first]] = own[first]
            labels[b][parts - 1 - places[~first]] = own[~first]
        else:
            before = np.empty(parts, dtype=np.int32)
            before[places] = own
            labels[a], labels[b] = before[:filled].copy(), before[::-1][:others].copy()
    return out


def _level(items: DataFrame, parts: int) -> DataFrame:
    """Difference the items of each cell: (cell, item, bytes) -> the same with their part."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "item"], ascending=[False, True], kind="stable")
        return frame.assign(part=difference(frame["bytes"].to_numpy(), parts))

    return items.groupBy("cell").applyInPandas(run, "cell long, item string, bytes long, part int")


def assign_groups(groups: DataFrame, parts: int, cell_items: int = 4000) -> DataFrame:
    """Shard of every group: (item string, bytes long) -> (item, shard). Items are unique.

    No task sees more than about ``cell_items`` items below the root, and twice that and ``parts`` times
    ``HEAVY`` at the root. A cell has at least ``LEAST`` items for each part, so that every level is smaller than the
    one before, whatever the number of parts.
    """
    cell_items = max(cell_items, LEAST * parts)
    groups = stage(groups, "shard-groups")
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    weight = max(1, total // (parts * HEAVY))
    if n <= cell_items:
        root = groups.select(F.lit(0).cast("long").alias("cell"), "item", "bytes")
        return _level(root, parts).select("item", F.col("part").alias("shard"))
    heavy = groups.where(F.col("bytes") >= weight)
    items = groups.where(F.col("bytes") < weight)
    count, links = n, []
    while True:
        cells = -(-count // cell_items)
        items = items.withColumn("cell", F.pmod(F.xxhash64("item"), F.lit(cells)))
        last = cells * parts <= cell_items
        # The last level leaves one cell open: its items enter the root one by one and even out the rest.
        closed = items.where("cell > 0") if last else items
        level = stage(_level(closed.select("cell", "item", "bytes"), parts), "shard-level")
        # A part of a cell is an item of the next level.
        name = F.concat_ws(":", F.lit(len(links)), "cell", "part")
        links.append(level.select("item", name.alias("next")))
        below = items.where("cell = 0").select("item", "bytes")
        items = level.groupBy(name.alias("item")).agg(F.sum("bytes").alias("bytes"))
        count = cells * parts
        if last:
            break
    single = heavy.select("item", "bytes").unionByName(below)
    # At most parts * HEAVY single groups, and twice about cell_items items, meet here.
    root = items.unionByName(single).select(F.lit(0).cast("long").alias("cell"), "item", "bytes")
    final = stage(_level(root, parts).select("item", F.col("part").alias("shard")), "shard-root")
    # Down again: an item that was left open has its shard already, the others take that of their part.
    placed = final
    for link in reversed(links):
        opened = placed.join(link.select(F.col("next").alias("item")).distinct(), "item", "left_anti")
        placed = link.join(placed.withColumnRenamed("item", "next"), "next").select("item", "shard").unionByName(opened)
    return placed


def shard(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", rows_per_slot_run: int = 2000
) -> DataFrame:
    """Place every row: (id, size, text_crc32, law, shard, slot, grown_shard).

    The law is ``bytes``: sizes of the shards as near equal as differencing gets them, equal texts in one
    shard. Whole texts count, however long. ``size`` is the UTF-8 length plus 16. A null text has size 16 and CRC 0; null texts are one
    group, apart from empty ones. Rows that repeat are all placed, in the same shard. Slots count from 0
    without gaps in each shard. Ids may be null or repeated. Columns other than the two named are not
    read. An empty table gives an empty result. ``grown_shard`` is null: adding a shard moves groups.

    Slots: each shard's rows are cut into runs of about ``rows_per_slot_run`` rows by a hash; a run is
    numbered by itself, behind the rows of the runs before it.
    """
    text = F.col(f"`{text_col}`")
    rows = stage(
        docs.select(
            F.col(f"`{id_col}`").alias(id_col),
            (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("null")).alias("item"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    placed = assign_groups(rows.groupBy("item").agg(F.sum("size").alias("bytes")), shards)
    rows = stage(rows.join(placed, "item").drop("item"), "shard-placed")
    counts = rows.groupBy("shard").count()
    runs = F.broadcast(  # one row for each shard
        counts.select("shard", F.ceil(F.col("count") / rows_per_slot_run).cast("int").alias("runs"))
    )
    rows = rows.join(runs, "shard").withColumn("run", F.pmod(F.xxhash64("row"), F.col("runs"))).drop("runs")
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "run")
        .count()
        .select("shard", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "run").orderBy(id_col, "row"))
    return (
        rows.withColumn("number", number)
        .join(offsets, ["shard", "run"])
        .select(
            id_col,
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
