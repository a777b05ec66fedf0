"""Connected components by alternating stars, and joins of per-key values that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import cut_lineage

# A key with this share of all rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()


def connected(edges: DataFrame) -> DataFrame:
    """(a, b): every node that has a smaller one in its component, with the smallest.

    ``edges`` has two columns of one type; direction, order and repeats don't
    matter, nulls and loops are ignored. Each round is two grouped minima
    (partial before the shuffle) and joins, written to the shared folder; the
    number of rounds grows with the logarithm of the component size. Nothing
    but two checksums of a round reaches the driver.
    """
    a, b = edges.columns
    current = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = cut_lineage(current.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut_lineage(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        current = cut_lineage(small, "small-star")
        before, state = state, _state(current)
        if state == before:
            break
    return current


def join_values(rows: DataFrame, values: DataFrame, key: str, n: str) -> DataFrame:
    """Rows with the columns of ``values`` (one row per key; ``n`` is the key's number of rows) joined on ``key``.

    The keys with at least ``HOT_SHARE`` of all rows are at most 1,000 and are
    broadcast, so their rows are not shuffled; no other key is large. Both
    inputs are read twice: pass stored tables.
    """
    total = values.agg(F.sum(n)).first()[0] or 0
    hot = values.filter(F.col(n) >= total * HOT_SHARE)
    cold = values.filter(F.col(n) < total * HOT_SHARE)
    few = F.broadcast(hot)
    return rows.join(few, key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))
