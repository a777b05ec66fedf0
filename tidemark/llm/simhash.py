"""SimHash near-duplicates by segment-popcount embedding.

A text's fingerprint is the bitwise majority of the hashes of its word
shingles. Fingerprints are embedded as the bit counts of their sixteen 4-bit
segments. The Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints, so all links lie in a range join on the lattice of
bit counts: every distinct fingerprint is entered in the cells within half the
range of its own cell, and two in range always share a cell (a point halfway).
Pairs that share a cell are verified on the bits.

Cells with more than ``CROWD`` fingerprints are not paired up. Their members are
entered once more, in the Hamming balls of half the range around every
fingerprint they can reach; members of one ball are linked by definition, so a
link to the ball's smallest member is all a ball gives. No cap loses a link and
no cell costs more than its members times a constant.

Defined results: a null or empty text, or one of spaces only, has fingerprint
zero, which links like any other; fewer words than a shingle form one shingle;
repeated rows give repeated results; a null key never names a component unless
all its members' keys are null (then the component is null). Other columns of
the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_digest

from tidemark.llm.common import batched, documents, id_text, slices, texts
from tidemark.llm.components import connected, join_values
from tidemark.session import cut_lineage

SEED = 42
SHINGLE = 3
MAX_DISTANCE = 2
CROWD = 16
# Hashes of one text that are counted at a time.
_BLOCK = 1 << 16
_FIVES, _THREES = 0x5555555555555555, 0x3333333333333333


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit majority fingerprint of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only the six ASCII spaces part
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), _BLOCK):
        hashes = b"".join([xxh64_digest(line[s:e], SEED) for s, e in zip(starts[at:], ends[at : at + _BLOCK])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(ends)).tobytes(), "big", signed=True)


def with_fingerprint(rows: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with their fingerprint instead of the text."""
    kept = [f for f in rows.schema.fields if f.name != text_col]

    def run(batches):
        for batch in slices(batches, text_col):
            prints = pa.array([fingerprint(t, shingle) for t in texts(batch, text_col)], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], prints], [*[f.name for f in kept], name])

    return rows.mapInArrow(run, StructType([*kept, StructField(name, LongType())]))


def popcounts(fp: Column) -> Column:
    """Bit counts of the sixteen 4-bit segments, each in its own 4 bits; half adders, so nothing overflows."""
    low, high = fp.bitwiseAND(F.lit(_FIVES)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_FIVES))
    pairs = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    return pairs.bitwiseAND(F.lit(_THREES)) + F.shiftrightunsigned(pairs, 2).bitwiseAND(F.lit(_THREES))


def _steps(cell: Column) -> Column:
    """The cell and its neighbours at Manhattan distance one; null where a count would leave 0..4."""
    out = [cell]
    for i in range(16):
        count = F.shiftrightunsigned(cell, 4 * i).bitwiseAND(F.lit(15))
        out += [F.when(count < 4, cell + F.lit(1 << 4 * i)), F.when(count > 0, cell - F.lit(1 << 4 * i))]
    return F.array(*out)


def _flips(fp: Column) -> Column:
    """The fingerprint and those one bit away."""
    return F.array(fp, *[fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])


def _ball(center: Column, steps, radius: int) -> Column:
    points = F.array(center)
    for _ in range(radius):
        points = F.array_distinct(F.flatten(F.transform(points, steps)))
    return points


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, crowd: int = CROWD) -> DataFrame:
    """(a, b) edges that connect all distinct fingerprints ``fp`` at most ``max_distance`` bits apart, and no others.

    ``max_distance`` is even, so that half of it is a whole number of steps.
    """
    if max_distance < 0 or max_distance % 2:
        raise ValueError("max_distance must be even")
    radius = max_distance // 2
    cells = prints.select("fp", F.explode(_ball(popcounts(F.col("fp")), _steps, radius)).alias("cell")).filter("cell IS NOT NULL")
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    stats = cut_lineage(stats, "simhash-cells")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = stats.filter("n = 2").select("a", "b")
    several = cut_lineage(cells.join(stats.filter("n > 2").select("cell", "n"), "cell"), "simhash-shared")
    some = several.filter(F.col("n") <= crowd)
    pairs = pairs.unionByName(some.select("cell", F.col("fp").alias("a")).join(some.select("cell", F.col("fp").alias("b")), "cell").filter("a < b").select("a", "b"))
    crowded = several.filter(F.col("n") > crowd).select("fp").distinct()
    balls = crowded.select("fp", F.explode(_ball(F.col("fp"), _flips, radius)).alias("center"))
    first = balls.groupBy("center").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    stars = balls.join(first, "center").filter("fp != a").select("a", F.col("fp").alias("b"))
    return pairs.filter(near).unionByName(stars).distinct()


def groups(table: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Per distinct fingerprint of a stored (doc_id, fp) table: ``n`` rows, ``root`` fingerprint and ``component_id``."""
    prints = cut_lineage(table.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "simhash-prints")
    roots = connected(links(prints.select("fp"), max_distance)).select(F.col("a").alias("fp"), F.col("b").alias("up"))
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("up", "fp")).drop("up")
    # Only members of components with several fingerprints meet; their least key is a partial aggregate.
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return cut_lineage(rooted.join(lowest, "root").select("fp", "n", "root", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row; fingerprints of all rows link transitively at ``max_distance`` bits."""
    table = cut_lineage(with_fingerprint(id_text(docs, id_col, text_col), "text", "fp", shingle), "simhash-rows")
    return join_values(table, groups(table, max_distance).drop("root"), "fp", "n").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates: that with the least key (a null key last), one of repeated rows."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    packed = batched(docs).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.struct(*columns).alias("_row"))
    table = cut_lineage(with_fingerprint(id_text(docs), "text", "fp", shingle), "simhash-rows")
    members = table.groupBy("fp", "doc_id").agg(F.count("*").alias("same"))
    members = members.join(groups(table, max_distance).select("fp", "root"), "fp")
    # The smallest of a component is a partial aggregate: a large one leaves each task as one row.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "same")
    kept = members.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("keep"), F.col("k.fp").alias("fp"), F.col("k.same").alias("same"))
    kept = cut_lineage(kept, "simhash-kept")
    rows = with_fingerprint(packed, "_text", "fp", shingle)
    rows = rows.join(kept.withColumnRenamed("fp", "fp2"), (F.col("fp") == F.col("fp2")) & F.col("_id").eqNullSafe(F.col("keep")))
    if kept.filter("same > 1").isEmpty():
        chosen = rows
    else:
        chosen = rows.filter("same = 1").unionByName(rows.filter("same > 1").dropDuplicates(["fp", "_id"]))
    return chosen.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
