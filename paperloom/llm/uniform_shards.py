"""Sharding: a uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Only DataFrame functions work on rows. The matrix, whose size does not depend on
the data, is drawn on the driver.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.scratch import stored

SHARDS = 16
#: Parts that rows are dealt from; with the shards they fix the matrix's size.
PARTS = 256
#: Rows ranked together in one window task.
RANK_ROWS = 4_000
_SEED = 9


def communication_matrix(parts: list[int], shards: list[int], seed: int = _SEED) -> list[list[int]]:
    """Rows that each part sends to each shard: a draw from the matrices with these row and column sums
    that a uniform permutation of all rows gives.

    The columns of each row are drawn one after the other from hypergeometric distributions.
    """
    rng = random.Random(seed)
    left, matrix = list(shards), []
    for n in parts:
        row, rest = [], sum(left)
        for j, room in enumerate(left):
            taken = _hypergeometric(rng, room, rest - room, n)
            row.append(taken)
            n, rest = n - taken, rest - room
            left[j] = room - taken
        matrix.append(row)
    return matrix


def _hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without replacement, by inversion from the mode outwards."""
    from math import exp, lgamma

    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    mode = min(max((good + 1) * (draws + 1) // (good + bad + 2), low), high)
    p = exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    u = rng.random() - p
    up, down, a, b = p, p, mode, mode
    while u > 0 and (a < high or b > low):
        if a < high:
            up *= (good - a) * (draws - a) / ((a + 1) * (bad - draws + a + 1))
            a += 1
            u -= up
            if u <= 0:
                return a
        if b > low:
            down *= b * (bad - draws + b) / ((good - b + 1) * (draws - b + 1))
            b -= 1
            u -= down
            if u <= 0:
                return b
    return mode


def ranked(rows: DataFrame, group: str, key: str, tie: str, total: int, name: str) -> DataFrame:
    """``rows`` with their place from 0 within ``group`` by ``key`` (random longs) and ``tie``.

    Keys are cut into equal ranges of about RANK_ROWS rows, and groups of
    ranges; a range's offset is the number of rows in those before it, so that
    no task holds a whole group.
    """
    bins = 1
    while bins * RANK_ROWS < total:
        bins *= 2
    bits = bins.bit_length() - 1
    rows = rows.withColumn("_bin", F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long"))
    high = F.shiftright("_bin", 10)
    per_bin = rows.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    per_high = per_bin.groupBy(group, high.alias("_high")).agg(F.sum("_n").alias("_n"))
    ahead = Window.partitionBy(group).orderBy("_high").rowsBetween(Window.unboundedPreceding, -1)
    per_high = per_high.select(group, "_high", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    within = Window.partitionBy(group, "_high").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.withColumn("_high", high).withColumn("_next", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    offset = per_bin.join(per_high, [group, "_high"]).select(group, "_bin", (F.col("_first") + F.col("_next")).alias("_offset"))
    order = Window.partitionBy(group, "_bin").orderBy(key, tie)
    placed = rows.join(offset, [group, "_bin"]).withColumn(name, F.col("_offset") + F.row_number().over(order) - 1)
    return placed.drop("_bin", "_offset")


def _random(salt: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(_SEED), F.lit(salt), *columns)


def shard(docs: DataFrame, shards: int = SHARDS, parts: int = PARTS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row of ``docs(doc_id, text)``.

    The law is ``rows``: shards differ by one row at most, the first ones
    being the larger. Rows are dealt to ``parts`` by hash, the matrix says how
    many of each part go to each shard, a random order within the part says
    which, and a second random order within the shard gives the slots, gapless
    from 0. Every assignment of rows to slots is equally likely as far as the
    hash is random; reruns agree. Null texts have size 1 and the check sum of
    no bytes. Rows equal in all respects are told apart by their place in the
    written table. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    slim = stored(slim.withColumn("rid", F.monotonically_increasing_id()), "shard-rows")
    part = F.pmod(_random(0, "doc_id", "text_crc32", "size"), F.lit(parts)).cast("int")
    rows = slim.withColumn("part", part).withColumn("k1", _random(1, "doc_id", "text_crc32")).withColumn("k2", _random(2, "doc_id", "text_crc32"))
    counts = dict(rows.groupBy("part").count().collect())  # ``parts`` rows at most
    each = [counts.get(p, 0) for p in range(parts)]
    total = sum(each)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(each, room)
    ends = [[sum(row[: j + 1]) for j in range(shards)] for row in matrix]
    table = docs.sparkSession.createDataFrame([(p, e) for p, e in enumerate(ends)], "part int, ends array<long>")
    dealt = ranked(rows, "part", "k1", "rid", total // parts, "_at").join(F.broadcast(table), "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_at"))).cast("int"))
    dealt = dealt.select("doc_id", "size", "text_crc32", "rid", "k2", "shard")
    placed = ranked(dealt, "shard", "k2", "rid", -(-total // shards), "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
