"""Keyed-table operators: pure functions from DataFrames to DataFrames.

Every reduction per key is an aggregate, not a window: partial aggregation
shrinks a key to one row per task before the shuffle, so a key that holds a
third of all rows costs no more than any other. Every key match is a plain
equi-join against a side that holds each key once; no broadcast is forced,
adaptive execution broadcasts a batch only once its measured size allows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

DELETE = "d"


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the remaining columns.

    Comparing the whole row makes the winner the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rank = [c for c in order if c not in keys]
    rank += [c for c in rest if c not in rank and _orderable(df.schema[c].dataType)]
    if len(rank) == len(rest):
        best = F.max(F.struct(*rank))
    else:
        best = F.max_by(F.struct(*rest), F.struct(*rank))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def columns_of(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def precombine(batch: DataFrame, keys: Sequence[str], ordering: str | Sequence[str]) -> DataFrame:
    """Reduce duplicate keys inside one batch to the row with the greatest ordering values."""
    return latest_by_key(batch, keys, columns_of(ordering))


def refuse_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job at the first row whose record key is NULL (checked while rows pass, no extra scan)."""
    return df.withColumns(
        {
            k: F.when(F.col(k).isNotNull(), F.col(k)).otherwise(
                F.raise_error(F.lit(f"record key column {k} is NULL")).cast(df.schema[k].dataType)
            )
            for k in keys
        }
    )


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, NULL for missing columns; a changed column type is refused."""
    types: dict[str, DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if types.setdefault(field.name, field.dataType) != field.dataType:
                raise TypeError(f"column {field.name}: {types[field.name].simpleString()} vs {field.dataType.simpleString()}")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def upsert(
    base: DataFrame, batch: DataFrame, keys: Sequence[str], ordering: str | Sequence[str], mode: str = "commit_time", reduced: bool = False
) -> DataFrame:
    """Insert new keys and replace existing ones whole-row.

    ``commit_time``: the incoming row wins. ``event_time``: the greater ordering
    value wins, the incoming row on a tie. ``reduced``: the batch holds each key once.
    """
    if not reduced:
        batch = precombine(batch, keys, ordering)
    untouched = base.join(batch.select(*keys), list(keys), "left_anti")
    if mode == "commit_time":
        return concat_by_name(untouched, batch)
    if mode == "event_time":
        # Only stored rows with a key in the batch compete; the rest of the base is not reduced.
        stored = base.join(batch.select(*keys), list(keys), "left_semi").withColumn("_in", F.lit(0))
        both = concat_by_name(stored, batch.withColumn("_in", F.lit(1)))
        return concat_by_name(untouched, latest_by_key(both, keys, [*columns_of(ordering), "_in"]).drop("_in"))
    raise ValueError(f"unknown upsert mode: {mode}")


def insert(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Plain append: no key lookup, no de-duplication."""
    return concat_by_name(base, rows)


def delete(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``batch``; other columns of the batch (ordering included) are ignored."""
    return base.join(batch.select(*keys).distinct(), list(keys), "left_anti")


def delete_using(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """DELETE ... USING: same rows as :func:`delete`, matched on any column list."""
    return delete(target, source, on)


def returning(target: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """RETURNING of an update or delete: the touched target rows projected to ``columns``."""
    touched = target.join(source.select(*on).distinct(), list(on), "left_semi")
    return touched.select(*(columns or on))


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... FROM: apply ``assignments`` (over target columns) to rows whose key is in ``source``."""
    marked = target.join(source.select(*on).distinct().withColumn("_hit", F.lit(True)), list(on), "left")
    return marked.select(
        *[
            F.when(F.col("_hit"), assignments[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in assignments
            else F.col(c)
            for c in target.columns
        ]
    )


def update_with(
    target: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str], ordering: Sequence[str] = ()
) -> DataFrame:
    """UPDATE ... FROM taking the new values from ``source``.

    Where the source repeats a key, its greatest row by ``ordering`` and then by
    the assigned columns counts, so a target row never multiplies.
    """
    new = latest_by_key(source.select(*dict.fromkeys([*on, *columns, *ordering])), on, ordering)
    new = new.select(*on, F.struct(*columns).alias("_new"))
    marked = target.join(new, list(on), "left")
    return marked.select(
        *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


# ---- change logs: rows carry the instant they were committed at and an operation -------------------


def snapshot(log: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op") -> DataFrame:
    """Latest live row per key of a change log; keys whose last operation is a delete are absent."""
    return latest_by_key(log, keys, order).filter(F.col(op) != DELETE)


def as_of(log: DataFrame, keys: Sequence[str], order: Sequence[str], commit: str, at: str, op: str = "op") -> DataFrame:
    """Snapshot as it stood after commit ``at``.

    The bound reaches the scan where ``commit`` is a column of the file or a
    partition; bound a derived commit by its source column as well.
    """
    return snapshot(log.filter(F.col(commit) <= at), keys, order, op)


def incremental(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    commit: str,
    begin: str,
    end: str | None = None,
    op: str = "op",
    changes: bool = False,
) -> DataFrame:
    """Latest version of each key committed in ``(begin, end]``.

    Deletes are not shown unless ``changes`` asks for the tombstones too.
    """
    log = log.filter(F.col(commit) > begin)
    if end is not None:
        log = log.filter(F.col(commit) <= end)
    latest = latest_by_key(log, keys, order)
    return latest if changes else latest.filter(F.col(op) != DELETE)


def commit_timeline(log: DataFrame, commit: str, op: str = "op") -> DataFrame:
    """Ordered instants of a change log with the rows each one wrote and deleted."""
    return log.groupBy(commit).agg(F.count("*").alias("n_rows"), F.count_if(F.col(op) == DELETE).alias("n_deletes"))
