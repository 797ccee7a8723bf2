"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows lie in source partitions. How many rows each partition sends to each shard is drawn from the law that a uniformly random
permutation of all rows would give (a multivariate hypergeometric law, one partition after the other without replacement).
Each partition permutes its own rows and deals them out by its row of the matrix, the rows are exchanged, and each shard permutes what it got.
Only the matrix, partitions times shards counts, is drawn outside the executors.

Defined cases: null texts have no bytes; equal rows are told apart by their place and may part; an empty table gives an empty result; other
columns stay in ``row`` whatever their names.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.session import cut_lineage


def hypergeometric(rng: random.Random, total: int, good: int, drawn: int) -> int:
    """Good items among ``drawn`` of ``total`` items. Inversion outwards from the mode: a few standard deviations of steps at any size."""
    low, high = max(0, drawn - (total - good)), min(good, drawn)
    if low == high:
        return low
    lf = lambda n: math.lgamma(n + 1)
    log_choose = lambda n, k: lf(n) - lf(k) - lf(n - k)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    at_mode = math.exp(log_choose(good, mode) + log_choose(total - good, drawn - mode) - log_choose(total, drawn))
    left = rng.random() - at_mode
    down = up = mode
    p_down = p_up = at_mode
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (total - good - drawn + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (total - good - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def shard_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows sum to the partitions' counts, columns to shard sizes that differ by one at most."""
    rng, room = random.Random(seed), shard_sizes(sum(counts), shards)
    matrix = []
    for count in counts:
        row, free, left = [], sum(room), count
        for s in range(shards):
            take = hypergeometric(rng, free, room[s], left)
            free, left = free - room[s], left - take
            row.append(take)
        room = [r - t for r, t in zip(room, row, strict=True)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int = 8, seed: int = 7, rows_per_part: int = 100_000) -> DataFrame:
    """``df`` as ``row`` with ``shard`` and ``slot`` (0, 1, ... in each shard, in random order).

    The rows are written once with their source partition and random keys, so that a lost executor cannot change what was counted.
    ``rows_per_part`` bounds the rows that one task sorts, when partitions and when shards are permuted.
    """
    place = F.monotonically_increasing_id()
    source = df.select(F.struct("*").alias("row"), place.alias("place"))
    # A source partition larger than the bound counts as several.
    part = F.concat_ws("-", F.shiftright("place", 33), F.floor((F.col("place") % F.lit(1 << 33)) / rows_per_part))
    staged = cut_lineage(source.select("row", part.alias("part"), F.xxhash64(F.lit(seed), "place").alias("k1"), F.xxhash64(F.lit(seed + 1), "place").alias("k2"), "place"), "shuffle-rows")
    counts = [(r["part"], r["n"]) for r in staged.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()]
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    upto = [[sum(row[: s + 1]) for s in range(shards)] for row in matrix]
    spark = df.sparkSession
    plan = spark.createDataFrame([(p, u) for (p, _), u in zip(counts, upto, strict=True)], "part string, upto array<bigint>")
    local = Window.partitionBy("part").orderBy("k1", "place")
    dealt = staged.withColumn("rank", F.row_number().over(local) - 1).join(plan, "part")
    dealt = dealt.select("row", "k2", "place", F.size(F.filter("upto", lambda c: c <= F.col("rank"))).alias("shard"))
    # Second permutation: a shard is cut by the leading bits of its random keys into pieces that one task can sort.
    pieces = max(1, math.ceil(sum(n for _, n in counts) / shards / rows_per_part))
    piece = F.floor(F.pmod(F.shiftright("k2", 8), F.lit(1 << 40)) * pieces / (1 << 40)).cast("int")
    exchanged = cut_lineage(dealt.withColumn("piece", piece), "shuffle-exchange")
    sizes = exchanged.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy("k2", "place")
    placed = exchanged.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["shard", "piece"])
    return placed.select("row", "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))
