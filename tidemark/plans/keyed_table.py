"""Keyed rows kept as plain parquet folders, and append-only change logs.

:class:`BucketedTable` holds one row per key in folders by a hash bucket of the
key. A batch reads and rewrites only the buckets its keys fall into (Spark's
dynamic partition overwrite), so its cost follows the batch and not the age of
the table; ``buckets`` bounds the rows of a folder (some 100 MB each is a good size; a greater one is written as several sorted files). There is no list of commits:
a row carries the instant it was committed at, and a source (a stream's
checkpoint) has one small record with the number of its last batch.

One writer at a time. A batch's merged buckets are staged as a whole before they
replace the old ones; if the writer dies in between, the next write first puts
the staged buckets in place again, and a batch that runs twice changes nothing.
Readers read between writes.

:class:`ChangeLog` appends every commit as a folder of its own. Snapshots, states
as of a commit and increments are reductions per key of the folders in range.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators import keyed as K
from tidemark.session import cut_lineage, get_line, listed, put_line, remove

COMMIT = "_commit"
BUCKET = "_bucket"
OP = "_op"


def clock() -> str:
    now = time.time()
    return time.strftime("%Y%m%d%H%M%S", time.gmtime(now)) + f"{int(now * 1000) % 1000:03d}"


class BucketedTable:
    """Upsert, delete and mixed changes by key; whole and incremental reads.

    ``mode`` decides between a stored and an incoming row: ``commit_time`` (the
    later commit wins) or ``event_time`` (the greater ordering value wins, the
    incoming row on a tie). Deletes always apply. ``expire`` gives, for a
    batch, the condition of rows that leave when their bucket is rewritten.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], ordering: str | Sequence[str], mode: str = "commit_time",
        buckets: int = 16, cluster_by: Sequence[str] | None = None, expire=None,
    ):
        if mode not in ("commit_time", "event_time"):
            raise ValueError(f"unknown merge mode: {mode}")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.ordering, self.mode, self.buckets = list(keys), K.columns_of(ordering), mode, buckets
        self.cluster_by, self.expire = list(cluster_by or self.keys), expire
        self._known: StructType | None = None
        folders = [n for n in listed(spark, self.path) if n.startswith("rows-")]
        if folders and folders != [self._rows.rsplit("/", 1)[1]]:
            raise ValueError(f"the table lies in {folders[0]}: open it with that number of buckets")

    # ---- reads --------------------------------------------------------------------------------

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows-{self.buckets}"

    def _schema(self) -> StructType | None:
        """Columns of the stored rows; read from the files once, then kept up by the writer."""
        if self._known is None and any(n.startswith(f"{BUCKET}=") for n in listed(self.spark, self._rows)):
            found = self.spark.read.option("mergeSchema", True).parquet(self._rows).schema
            self._known = StructType([f for f in found.fields if f.name != BUCKET])
        return self._known

    def _stored(self, schema: StructType) -> DataFrame:
        """Rows under the latest schema with their bucket; columns older files lack read NULL."""
        full = StructType(list(schema.fields)).add(BUCKET, "integer")
        if not listed(self.spark, self._rows):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(self._rows)

    def snapshot(self, meta: bool = False) -> DataFrame:
        """The row of every key; ``meta`` adds the commit it was written by."""
        schema = self._schema()
        if schema is None:
            raise ValueError("table has no rows")
        out = self._stored(schema).drop(BUCKET)
        return out if meta else out.drop(COMMIT)

    def incremental(self, begin: str, end: str | None = None) -> DataFrame:
        """Rows whose current version was committed in ``(begin, end]``; the bound reaches the scan."""
        rows = self.snapshot(meta=True).filter(F.col(COMMIT) > begin)
        return rows if end is None else rows.filter(F.col(COMMIT) <= end)

    # ---- writes -------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, commit: str | None = None) -> str:
        """Replace all rows; keys the frame repeats are reduced by the ordering columns."""
        return self._replace(K.precombine(df, self.keys, self.ordering), commit)

    def bulk_insert(self, df: DataFrame, commit: str | None = None) -> str:
        """Establish the table from a frame as it is: no key lookup, no reduction."""
        return self._replace(df, commit)

    def _replace(self, df: DataFrame, commit: str | None) -> str:
        commit = commit or clock()
        self._finish()
        rows = self._with_bucket(K.refuse_null_keys(df, self.keys).withColumn(COMMIT, F.lit(commit)))
        self._stage(rows, list(range(self.buckets)))
        self._known = StructType([f for f in rows.schema.fields if f.name != BUCKET])
        self._finish()
        return commit

    def upsert(self, batch: DataFrame, commit: str | None = None, source: str | None = None, number: int = 0) -> bool:
        """Insert new keys, replace existing ones whole-row; new columns evolve the table. Whether it was applied.

        Of a named ``source`` only batches with a greater ``number`` than the last are applied.
        """
        rows = K.refuse_null_keys(K.precombine(batch, self.keys, self.ordering), self.keys)
        return self._apply(rows.withColumn(OP, F.lit("u")), commit, source, number, deletes=False)

    def delete(self, batch: DataFrame, commit: str | None = None, source: str | None = None, number: int = 0) -> bool:
        """Remove the keys in ``batch``, which needs no other column."""
        return self._apply(batch.select(*self.keys).distinct().withColumn(OP, F.lit(K.DELETE)), commit, source, number)

    def change(self, batch: DataFrame, op: str, order: Sequence[str], commit: str | None = None, source: str | None = None, number: int = 0) -> bool:
        """Apply a mixed batch of upserts and deletes: the last change per key by ``order`` decides."""
        last = K.refuse_null_keys(K.latest_by_key(batch, self.keys, order), self.keys)
        kind = F.when(F.col(op) == K.DELETE, K.DELETE).otherwise("u")
        return self._apply(last.withColumn(OP, kind).drop(*({op} - {OP})), commit, source, number)

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _evolved(self, batch: StructType) -> StructType:
        """Stored columns and the batch's new ones; changed types are refused."""
        known = self._schema() or StructType([])
        known = StructType(list(known.fields))
        for field in batch.fields:
            if field.name not in known.names:
                known = known.add(field.name, field.dataType, True)
            elif known[field.name].dataType != field.dataType:
                raise TypeError(f"column {field.name}: {known[field.name].dataType.simpleString()} vs {field.dataType.simpleString()}")
        return known

    def _apply(self, rows: DataFrame, commit: str | None, source: str | None, number: int, deletes: bool = True) -> bool:
        """Merge changes that hold each key once."""
        self._finish()
        if source is not None and self._last(source) >= number:
            return False
        rows = self._with_bucket(rows)
        batch_columns = StructType([f for f in rows.schema.fields if f.name not in (OP, BUCKET)])
        schema = self._evolved(StructType(list(batch_columns.fields)).add(COMMIT, "string"))
        # The batch is stored once: its buckets, the merge and the condition of expiry read it back.
        batch = cut_lineage(rows.withColumn(COMMIT, F.lit(commit or clock())), "batch")
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # at most one a bucket
        if touched:
            stored = self._stored(schema).filter(F.col(BUCKET).isin(touched))
            merged = K.delete(stored, batch.filter(F.col(OP) == K.DELETE), self.keys) if deletes else stored
            if set(self.ordering) <= set(batch.columns):  # else a batch of keys to delete
                merged = K.upsert(merged, batch.filter(F.col(OP) != K.DELETE).drop(OP), self.keys, self.ordering, self.mode, reduced=True)
            if self.expire is not None:
                merged = merged.filter(~F.coalesce(self.expire(batch), F.lit(False)))
            self._stage(merged.select(*schema.names, BUCKET), touched)
            self._known = schema
            self._finish()
        if source is not None:
            put_line(self.spark, self._ledger(source), str(number))
        return True

    def _stage(self, merged: DataFrame, touched: list[int]) -> None:
        """Write what the touched buckets will hold, and, once that is whole, which they are."""
        merged.write.parquet(f"{self.path}/staged/rows")
        put_line(self.spark, f"{self.path}/staged/touched", ",".join(map(str, touched)))

    def _finish(self) -> None:
        """Put staged buckets in place; what was not staged as a whole goes.

        Adaptive execution gives a bucket as many tasks as its size asks for, and
        small buckets a task together: what a task sorts does not grow with the table.
        """
        staged = f"{self.path}/staged"
        line = get_line(self.spark, f"{staged}/touched")
        if line is not None:
            touched = {f"{BUCKET}={b}" for b in line.split(",")}
            rows = self.spark.read.parquet(f"{staged}/rows")
            full = {f"{BUCKET}={r[0]}" for r in rows.select(BUCKET).distinct().collect()}  # at most one a bucket
            if full:
                placed = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.cluster_by)
                placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self._rows)
            for name in sorted((touched - full) & set(listed(self.spark, self._rows))):
                remove(self.spark, f"{self._rows}/{name}")  # all its keys are gone
        remove(self.spark, staged)

    # ---- sources ------------------------------------------------------------------------------

    def _ledger(self, source: str) -> str:
        return f"{self.path}/applied/{hashlib.md5(source.encode()).hexdigest()}"

    def _last(self, source: str) -> int:
        """Number of the last batch of a source: one line of one file, however many there were."""
        return int(get_line(self.spark, self._ledger(source)) or -1)


class ChangeLog:
    """Commits of changes (rows with ``op``), a folder each; later commits win."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], ordering: str | Sequence[str], op: str = "op"):
        self.spark, self.path, self.keys, self.ordering, self.op = spark, path.rstrip("/"), list(keys), K.columns_of(ordering), op

    def append(self, changes: DataFrame, commit: str) -> None:
        """Write one commit; the same commit again replaces itself."""
        K.refuse_null_keys(changes, self.keys).write.mode("overwrite").parquet(f"{self.path}/{COMMIT}=c{commit}")

    def _range(self, condition: Column | None = None) -> DataFrame:
        """Changes with their commit; a condition on it opens only the folders in range."""
        log = self.spark.read.option("mergeSchema", True).parquet(self.path)
        return log if condition is None else log.filter(condition)

    def snapshot(self, as_of: str | None = None) -> DataFrame:
        """Live rows after all commits, or after commit ``as_of``."""
        log = self._range(None if as_of is None else F.col(COMMIT) <= f"c{as_of}")
        return K.snapshot(log, self.keys, [COMMIT, *self.ordering], self.op).drop(COMMIT, self.op)

    def incremental(self, begin: str, end: str | None = None, changes: bool = False) -> DataFrame:
        """Last change of each key committed in ``(begin, end]``; deletes only if ``changes``."""
        within = F.col(COMMIT) > f"c{begin}"
        log = self._range(within if end is None else within & (F.col(COMMIT) <= f"c{end}"))
        last = K.latest_by_key(log, self.keys, [COMMIT, *self.ordering])
        return last if changes else last.filter(F.col(self.op) != K.DELETE)
