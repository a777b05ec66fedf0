"""Helpers of the text operators: Arrow slices of bounded size, folds, size-checked filters built by Spark."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import ensure_session

# Text of one slice handed to Python code; a single longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Rows of an Arrow batch: Spark's own limit counts rows only, and a row is a whole text here.
BATCH_ROWS = 1000
# Bits of a filter that one collected row holds: a word without its sign.
WORD_BITS = 63


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched(ensure_session(spark).read.parquet(f"{sf_dir}/documents.parquet"))


def batched(df: DataFrame) -> DataFrame:
    """The frame; its session's Arrow batches hold ``BATCH_ROWS`` rows at most."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names: no other column of the caller can clash."""
    return batched(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def positional(df: DataFrame) -> DataFrame:
    """The frame with columns named by position: no name of the caller's (dots, quotes) stands in the way."""
    return batched(df).toDF(*[f"c{i}" for i in range(len(df.columns))])


def fold(column: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; a null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes in ``column``; empty batches are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.maximum(np.cumsum(sizes) - 1, 0) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one column replaced."""
    at = batch.schema.get_field_index(name)
    return batch.set_column(at, batch.schema.field(at), values)


def filter_bits(positions: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit array of ``bits`` bits with the bits named in ``column`` set.

    Tasks combine their positions into words of 63 bits before the one shuffle;
    the driver gets at most a row for each word, so its share is bounded by the
    filter's size, whatever the number of positions.
    """
    word, bit = F.expr(f"{column} div {WORD_BITS}"), F.expr(f"shiftleft(1L, cast({column} % {WORD_BITS} as int))")
    got = positions.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set")).toArrow()
    spread = np.zeros((bits + WORD_BITS - 1) // WORD_BITS, np.uint64)
    spread[got["word"].to_numpy()] = got["set"].to_numpy().view(np.uint64)
    return set_bits(spread)


def set_bits(words: np.ndarray) -> np.ndarray:
    """Words of 63 bits as bytes of 8."""
    ones = np.unpackbits(np.ascontiguousarray(words.astype("<u8")).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(ones[:, :WORD_BITS].ravel(), bitorder="little")


def has_bit(bits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (bits[positions >> np.uint64(3)] >> (positions & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def mix(keys: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix of unsigned 64-bit keys (multiply and xor-shift rounds)."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_ONCE: dict[str, tuple] = {}


def once(slot: str, name: str, build):
    """What ``build`` makes, kept by the worker process while ``slot`` is asked for the same ``name``."""
    if _ONCE.get(slot, ("",))[0] != name:
        _ONCE.pop(slot, None)
        _ONCE[slot] = (name, build())
    return _ONCE[slot][1]
