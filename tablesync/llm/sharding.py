"""Sharding by minimax contiguous partition of atomic groups. DataFrame functions only."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import partitions, running_total, stored, text_or_empty

#: Points on the line of group ends that one look at the table may bring to the driver.
POINTS = 8192


class EndLine:
    """What is known of the ascending ends of all groups: exact points, and gaps that may hide more.

    For a capacity, the greedy cut after position ``x`` lies between ``below(x)`` and ``above(x)``.
    """

    def __init__(self, total: int):
        self.points, self.gaps = [0, total], {0: total}

    def below(self, x: int) -> int:
        return self.points[bisect_right(self.points, x) - 1]

    def above(self, x: int) -> int:
        """An upper bound of the last end up to ``x``."""
        point = self.below(x)
        return min(x, self.gaps[point] - 1) if point in self.gaps and x > point else point

    def cuts(self, capacity: int, shards: int, step) -> list[int]:
        places = [0]
        for _ in range(shards):
            places.append(step(min(places[-1] + capacity, self.points[-1])))
        return places[1:]

    def smallest(self, shards: int, step, low: int) -> int:
        """The smallest capacity for which the greedy check reaches the end within ``shards``."""
        total, high = self.points[-1], self.points[-1]
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, step)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low

    def learn(self, blocks: list[tuple[int, int, int]], spans: list[tuple[int, int]]) -> None:
        """Take in blocks (first end, last end, ends in it) that cover all ends within the spans."""
        hidden = sorted((first, last) for first, last, count in blocks if count > 2)
        known = set(self.points).union(*[(first, last) for first, last, _ in blocks])
        before, self.points, self.gaps = sorted(self.gaps.items()), sorted(known), {}
        for start, end in zip(self.points, self.points[1:], strict=False):
            looked_at = _within(spans, start, end)
            if _within(before, start, end) and (not looked_at or _within(hidden, start, end)):
                self.gaps[start] = end


def _within(ranges: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of some ascending, disjoint ranges holds this one."""
    at = bisect_right(ranges, (start, float("inf"))) - 1
    return at >= 0 and end <= ranges[at][1]


def cut_places(ends: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """The greedy cuts at the smallest feasible capacity over all group ends.

    ``ends`` has one row per group with its exact running size ``end``; the driver sees at most
    POINTS of them a time: first evenly over the whole line, then around the places where a cut may
    still fall, until the capacity and all its cuts are exact.
    """
    line = EndLine(total)
    spans = [(0, total)]
    least = max(-(-total // shards), largest)
    while True:
        line.learn(_blocks(ends, spans), spans)
        sure = line.smallest(shards, line.below, least)
        hoped = line.smallest(shards, line.above, least)
        low = line.cuts(hoped, shards, line.below)
        high = line.cuts(sure, shards, line.above)
        if sure == hoped and low == high:
            return low
        spans = _merged([(_start(line, a), _end(line, b)) for a, b in zip(low, high, strict=True) if a < b])


def _start(line: EndLine, x: int) -> int:
    return line.below(x)


def _end(line: EndLine, x: int) -> int:
    return line.points[min(bisect_left(line.points, x), len(line.points) - 1)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def _blocks(ends: DataFrame, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    pieces = max(2, POINTS // len(spans))
    block: Column = F.lit(None).cast("long")
    inside: Column = F.lit(False)
    for k, (a, b) in enumerate(spans):
        step = max(1, -(-(b - a) // pieces))
        hit = F.col("end").between(a, b)
        block = F.when(hit, F.lit(k * (pieces + 2)) + F.floor((F.col("end") - F.lit(a)) / F.lit(step))).otherwise(block)
        inside = inside | hit
    rows = ends.where(inside).groupBy(block.alias("block")).agg(F.min("end"), F.max("end"), F.count("*")).collect()
    return [(first, last, count) for _, first, last, count in rows]


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put all documents into shards of nearly equal bytes, equal texts together.

    Method: the groups of equal texts, ordered by the SHA-256 of the text, are atomic. The smallest capacity
    for which a greedy pass needs at most ``shards`` shards is found by binary search, and the
    ordered groups are cut greedily at it. A shard is then a range of the order, so a document finds
    its shard by comparing its own digest with the cuts: no join, whatever the size of a group.

    Returns ``id_col``, size (UTF-8 bytes plus 8), text_crc32, text_sha256, law ``bytes``, shard,
    slot (0, 1, ... in each shard, by hash bucket and id) and grown_shard (always null). Defined
    cases: a null text counts as empty and goes with empty texts; rows with equal or null ids each
    get a slot; an empty table gives no rows; with fewer groups than shards the last shards stay
    empty; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    base = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("key"),
        ),
        "sharding",
    )
    spread = partitions(spark)
    head = F.conv(F.substring("key", 1, 6), 16, 10).cast("long")
    groups = base.groupBy("key").agg(F.sum("size").alias("bytes")).withColumn("bucket", F.shiftright(head * F.lit(spread), 24))
    sums = running_total(groups.groupBy("bucket").agg(F.sum("bytes").alias("all")), [], "bucket", "all", "before")
    inner = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    ends = stored(
        groups.withColumn("inner", F.sum("bytes").over(inner))
        .join(sums.select("bucket", "before"), "bucket")
        .select("key", "bytes", (F.col("before") + F.col("inner")).alias("end")),
        "sharding-groups",
    )
    total, largest = ends.agg(F.max("end"), F.max("bytes")).first()
    cuts: list[str] = []
    if total:
        places = sorted({p for p in cut_places(ends, total, largest, shards) if p < total})
        cuts = sorted(key for (key,) in ends.where(F.col("end").isin(places)).select("key").collect()) if places else []
    shard: Column = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") > F.lit(cut)).cast("int")
    placed = base.withColumn("shard", shard).withColumn("part", F.pmod(F.xxhash64("id", "key"), F.lit(spread)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = running_total(counts, ["shard"], "part", "n", "before").select("shard", "part", "before")
    order = Window.partitionBy("shard", "part").orderBy("id", "key")
    return (
        placed.withColumn("place", F.row_number().over(order))
        .join(starts, ["shard", "part"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.col("key").alias("text_sha256"),
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("before") + F.col("place") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
