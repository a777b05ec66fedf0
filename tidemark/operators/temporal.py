"""Versions of keyed rows over time: validity intervals and the state at an instant.

A window or a range join over a whole key puts a hot key into one task. Here
time is cut into buckets that hold at most ``BUCKET_ROWS`` versions of a key.
What a bucket needs from the others is one row, the last version before it or
the first after it, and is found among the buckets' summaries, level by level
in groups of ``FANOUT`` buckets. Rows asking for a state then meet one row per
key and bucket, so the join neither multiplies them nor compares ranges, and
adaptive execution may split a key they crowd on.

Defined results: rows of the log without key or instant belong to no version;
of several rows of a key at one instant the greatest by ``order`` counts; an
interval runs from its instant (inside) to the key's next one (outside), NULL
if there is none. Asking rows without key, without instant or before the first
version, and those of a deleted key, come back with NULLs; none is lost or
repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.keyed import DELETE, latest_by_key
from tidemark.session import cut_lineage

BUCKET_ROWS = 256
FANOUT = 4096
LEVELS = 2
# Longest bucket, in microseconds: a million days.
WIDEST = 86_400_000_000_000_000
_BUCKET = "_bucket"


def _bucket(instant: str, width: int) -> Column:
    return F.floor(F.unix_micros(F.col(instant).cast("timestamp")) / F.lit(width)).cast("bigint")


def _versions(log: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], max_rows: int) -> tuple[DataFrame, int]:
    """(one stored row per key and instant, width of a bucket)."""
    known = log
    for c in [*keys, at]:
        known = known.filter(F.col(c).isNotNull())
    versions = cut_lineage(latest_by_key(known, [*keys, at], order), "versions")
    width = WIDEST
    while True:
        # An instant stands once in a key, so buckets of one microsecond hold one version.
        counted = versions.groupBy(*keys, _bucket(at, width).alias(_BUCKET)).count()
        fullest = counted.agg(F.max("count")).first()[0] or 0
        if fullest <= max_rows:
            return versions.withColumn(_BUCKET, _bucket(at, width)), width
        width = max(1, int(width / max(2.0, 1.25 * fullest / max_rows)))


def carried(marks: DataFrame, keys: Sequence[str], forward: bool = False, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """``marks`` (one row per key and ``_bucket``) with ``_carry``: the nearest ``_value`` of an earlier bucket that has one.

    ``forward`` looks for the nearest later bucket instead.
    """
    direction, pick = (F.desc, F.min_by) if forward else (F.asc, F.max_by)
    grouped = marks.withColumn("_super", F.floor(F.col(_BUCKET) / fanout)) if levels else marks
    group = [*keys, "_super"] if levels else list(keys)
    passed = Window.partitionBy(*group).orderBy(direction(_BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    near = grouped.withColumn("_carry", F.last("_value", True).over(passed))
    if not levels:
        return near
    tops = grouped.groupBy(*group).agg(pick("_value", F.when(F.col("_value").isNotNull(), F.col(_BUCKET))).alias("_value"))
    tops = carried(tops.withColumnRenamed("_super", _BUCKET), keys, forward, levels - 1, fanout)
    tops = tops.select(*keys, F.col(_BUCKET).alias("_super"), F.col("_carry").alias("_far"))
    return near.join(tops, group).withColumn("_carry", F.coalesce("_carry", "_far")).drop("_super", "_far")


def validity_intervals(
    log: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], op: str = "op", max_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Every version of the log with ``valid_from`` and ``valid_to``; a delete ends an interval and starts none."""
    versions, _ = _versions(log, keys, at, order, max_rows)
    # Stored, as the log is read for the width, the buckets' first instants and the rows.
    marks = versions.groupBy(*keys, _BUCKET).agg(F.min(at).alias("_value"))
    later = carried(marks, keys, forward=True).select(*keys, _BUCKET, "_carry")
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(at)
    ended = versions.withColumn("_next", F.lead(at).over(inside)).join(later, [*keys, _BUCKET])
    ended = ended.withColumns({"valid_from": F.col(at), "valid_to": F.coalesce("_next", "_carry")})
    return ended.filter(F.col(op) != DELETE).drop(_BUCKET, "_next", "_carry")


def state_at(
    rows: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    asked: str,
    at: str,
    order: Sequence[str],
    columns: Mapping[str, str],
    op: str = "op",
    max_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``rows`` with the values their key had at instant ``asked``.

    ``columns`` maps a column of the log to the name its value gets; ``valid_from``
    says since when it held. A version counts from its own instant on.
    """
    versions, width = _versions(log, keys, at, order, max_rows)
    versions = versions.select(*keys, _BUCKET, F.struct(F.col(at).alias("_at"), F.col(op).alias("_op"), *columns).alias("_version"))
    rows = rows.withColumn(_BUCKET, _bucket(asked, width))
    wanted = rows.select(*keys, _BUCKET).distinct()
    for c in [*keys, _BUCKET]:
        wanted = wanted.filter(F.col(c).isNotNull())
    own = versions.groupBy(*keys, _BUCKET).agg(
        F.max_by("_version", F.col("_version._at")).alias("_value"), F.array_sort(F.collect_list("_version"), _by_instant).alias("_own")
    )
    kinds = {f.name: f.dataType for f in own.schema.fields}
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in ("_value", "_own")]
    both = own.withColumn("_asked", F.lit(False)).unionByName(wanted.select("*", *empty, F.lit(True).alias("_asked")))
    marks = both.groupBy(*keys, _BUCKET).agg(
        F.first("_value", True).alias("_value"), F.first("_own", True).alias("_own"), F.max("_asked").alias("_asked")
    )
    # Only the summaries pass the windows; the versions of a bucket wait for its row.
    marks = cut_lineage(marks, "buckets")
    before = carried(marks.select(*keys, _BUCKET, "_value"), keys).select(*keys, _BUCKET, "_carry")
    known = marks.filter("_asked").select(*keys, _BUCKET, "_own").join(before, [*keys, _BUCKET])
    known = known.withColumn("_known", F.concat(F.coalesce(F.array_compact(F.array("_carry")), F.array()), F.coalesce("_own", F.array())))
    known = known.select(*keys, _BUCKET, "_known")
    moment = F.col(asked).cast("timestamp")
    held = F.try_element_at(F.filter("_known", lambda v: v["_at"] <= moment), F.lit(-1))
    out = rows.join(known, [*keys, _BUCKET], "left").withColumn("_held", held)
    alive = F.col("_held._op") != DELETE
    values = [F.when(alive, F.col(f"_held.{c}")).alias(name) for c, name in columns.items()]
    kept = [c for c in rows.columns if c != _BUCKET]
    return out.select(*kept, F.when(alive, F.col("_held._at")).alias("valid_from"), *values)


def _by_instant(a: Column, b: Column) -> Column:
    return F.when(a["_at"] < b["_at"], -1).when(a["_at"] > b["_at"], 1).otherwise(0)
