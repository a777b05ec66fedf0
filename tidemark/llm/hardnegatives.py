"""Hard negatives from candidate blocks in the order of a Hilbert curve, with zone maps.

Rows are sorted along a Hilbert curve over all components (``BITS`` bits each)
and stored as Parquet rows of up to ``BLOCK_ROWS`` vectors: the block, with the
least and greatest value of every component (its zone map) and its labels.
``ZONE_BLOCKS`` blocks in a row are a zone, which is also the unit in which
anchors travel. Nothing of it is broadcast or collected.

An anchor's positives are its best rows of the same label; every positive opens
a window of scores, and the first rows of other labels inside it are the hard
negatives. Both are searched in two steps. The anchor's own zone gives a score
that the last of its results reaches at least. Then interval arithmetic on the
zone maps bounds the products of an anchor with all rows of a block from below
and above, and only blocks whose bounds meet a window (above what is known
already), and that hold a fitting label, are read for the anchor. The bounds
hold for every row, so the result is exact, whatever the data; the better the
curve gathers similar rows, the fewer blocks are read.

All anchors meet all zone maps, in blocks: anchors travel by zone to buckets of
``BUCKET_ZONES`` zone maps. Tasks keep the best rows of an anchor as they go and
send them on once there are ``PENDING`` of them.

Defined results: rows whose id, label or vector is null, or whose vector holds
null, NaN or infinite components, take no part. Vectors of different lengths
are never compared. Rows that repeat id, label and vector count once; rows with
the anchor's id are neither positives nor negatives of it. Equal scores go by
the smaller id. A vector whose products could leave the whole numbers a double
holds (2^53) fails the query. Empty vectors have the score 0. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut_lineage, ensure_session

POSITIVES, NEGATIVES = 5, 10
# Percent of a positive's score between which its negatives lie.
LOW, HIGH = 30, 90
SCALE = 256
BITS = 4
BLOCK_ROWS, ZONE_BLOCKS = 256, 16
BUCKET_ZONES = 64
PENDING = 1 << 18
# Rows of an Arrow batch: vectors, and later blocks or a zone's anchors.
BATCH_ROWS, BATCH_BLOCKS = 2048, 16
EXACT = 1 << 53
# Above the blocks of a zone and the rows of a block.
MOST = 1 << 10

_BLOCKS = "zone long, pos int, d int, ids binary, labels binary, anchors binary, z binary, lo binary, hi binary, kinds array<long>"
_ANCHOR = "uid long, zone long, d int, vec_id long, label long, z binary"


def rows_of(rows: DataFrame, anchor: Column, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, anchor, z) of the rows that take part; ``z`` holds whole numbers."""
    ensure_session(rows.sparkSession)
    picked = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    usable = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    whole = F.transform("v", lambda x: F.floor(x * SCALE))
    widest = F.aggregate("v", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x * SCALE) + 1))
    fits = widest * widest * F.size("v") < EXACT
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit("products of these vectors leave the exact whole numbers")).cast("array<long>"))
    return picked.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable).select("vec_id", "label", "anchor", checked.alias("z"))


# ---- the curve --------------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Position on the Hilbert curve of every row of cell numbers (0 to 2^bits - 1), as bytes that sort alike."""
    n, d = cells.shape
    if not d:
        return [b""] * n
    x = cells.T.astype(np.uint32).copy()
    for level in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    planes = np.stack([(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.reshape(bits * d, n).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrices(batch: pa.RecordBatch):
    """(rows of the batch, their ``z`` as a matrix) for each vector length."""
    column = batch.column("z")
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def _with_key(low: int, high: int):
    """Rows with vector length and curve position; cells divide the range of all components evenly."""
    width = max(high - low + 1, 1) / (1 << BITS)

    def run(batches):
        for batch in batches:
            keys, sizes = [b""] * batch.num_rows, np.zeros(batch.num_rows, np.int32)
            for at, z in _matrices(batch):
                sizes[at] = z.shape[1]
                for i, key in zip(at.tolist(), hilbert_keys(np.clip((z - low) // width, 0, (1 << BITS) - 1))):
                    keys[i] = key
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), pa.array(keys, pa.binary())], [*batch.schema.names, "d", "key"])

    return run


def _cut_blocks(batches, block_rows: int, zone_blocks: int):
    """Sorted rows to blocks; a zone holds one vector length, and the rows of a block lie by id."""
    task, zone, pos, held = TaskContext.get().partitionId(), 0, 0, None

    def block(ids, labels, flags, z):
        nonlocal zone, pos
        order = np.lexsort((labels, ids))
        ids, labels, flags, z = ids[order], labels[order], flags[order], z[order].astype("<i4")
        row = ((task << 32) + zone, pos, z.shape[1], ids.tobytes(), labels.tobytes(), flags.tobytes(), z.tobytes(), z.min(0).tobytes(), z.max(0).tobytes(), np.unique(labels).tolist())
        pos += 1
        if pos == zone_blocks:
            zone, pos = zone + 1, 0
        return _table([row], _BLOCKS)

    for batch in batches:
        for at, z in _matrices(batch):  # lengths ascend, as the rows are sorted by them
            part = [batch.column(c).to_numpy(zero_copy_only=False)[at] for c in ("vec_id", "label", "anchor")]
            part = [part[0].astype("<i8"), part[1].astype("<i8"), part[2].astype(np.uint8), z]
            if held is not None and held[3].shape[1] != z.shape[1]:
                if len(held[0]):
                    yield block(*held)
                if pos:
                    zone, pos = zone + 1, 0
                held = None
            if held is not None:
                part = [np.concatenate(c) for c in zip(held, part)]
            ids, labels, _, z = part
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (z[1:] != z[:-1]).any(1)
            part = [c[fresh] for c in part]
            # The last row is kept back: the next batch may repeat it.
            full = max(len(part[0]) - 1, 0) // block_rows * block_rows
            for s in range(0, full, block_rows):
                yield block(*[c[s : s + block_rows] for c in part])
            held = [c[full:] for c in part]
    if held is not None and len(held[0]):
        yield block(*held)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split(" ") for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def write_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS, zone_blocks: int = ZONE_BLOCKS) -> DataFrame:
    """The stored blocks of ``rows_of`` rows."""
    rows = cut_lineage(rows, "negatives-rows")
    low, high = rows.agg(F.min(F.array_min("z")), F.max(F.array_max("z"))).first()
    schema = "vec_id long, label long, anchor boolean, z array<long>, d int, key binary"
    keyed = cut_lineage(rows.mapInArrow(_with_key(low or 0, high or 0), schema), "negatives-keys")
    order = ["d", "key", "vec_id"]  # with the id, so that one hot vector is many ranges
    near = keyed.repartitionByRange(*order).sortWithinPartitions(*order, "label", "z", F.desc("anchor"))
    return cut_lineage(near.mapInArrow(lambda batches: _cut_blocks(batches, block_rows, zone_blocks), _BLOCKS), "negatives-blocks")


# ---- anchors ----------------------------------------------------------------------------------------


def _list_anchors(batches):
    for batch in batches:
        out = []
        for zone, pos, d, ids, labels, flags, z in zip(*(batch.column(c).to_pylist() for c in ("zone", "pos", "d", "ids", "labels", "anchors", "z"))):
            z = np.frombuffer(z, "<i4").reshape(-1, d) if d else np.zeros((len(flags), 0), "<i4")
            for i in np.flatnonzero(np.frombuffer(flags, np.uint8)).tolist():
                # Zone, block and row: unique, as none of the three reaches its part's end.
                uid = (zone * MOST + pos) * MOST + i
                out.append((uid, zone, d, int.from_bytes(ids[8 * i : 8 * i + 8], "little", signed=True), int.from_bytes(labels[8 * i : 8 * i + 8], "little", signed=True), z[i].tobytes()))
        if out:
            yield _table(out, _ANCHOR)


class _Anchors:
    """A zone's anchors, read from a list of structs, and their windows of scores (lowest, highest) as columns."""

    def __init__(self, listed: pa.Array, d: int):
        get = lambda c: listed.field(c).to_numpy(zero_copy_only=False)
        self.uid, self.vec_id, self.label, self.n = get("uid"), get("vec_id"), get("label"), len(listed)
        self.z = np.frombuffer(b"".join(listed.field("z").to_pylist()), "<i4").reshape(self.n, d).astype(float)
        sides = [np.array(listed.field(c).to_pylist(), float).reshape(self.n, -1) for c in ("low", "high")]
        self.low, self.high = sides


def _chosen(a: _Anchors, lo: np.ndarray, hi: np.ndarray, kinds: list[list[int]], same: bool) -> np.ndarray:
    """Whether each anchor must read each block: bounds of its products meet a window, and a label fits."""
    up, down = np.maximum(a.z, 0), np.minimum(a.z, 0)
    most, least = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
    meets = np.zeros(most.shape, bool)
    for w in range(a.low.shape[1]):
        meets |= (most >= a.low[:, w : w + 1]) & (least <= a.high[:, w : w + 1])
    for i, k in enumerate(kinds):
        meets[:, i] &= np.isin(a.label, k) if same else np.array([len(k) > 1]) | (a.label != k[0])
    return meets


def _choose(same: bool):
    """(anchors of a zone, zone maps of another) to the anchors with what they must read there: a bit a block and anchor."""

    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                d = batch.column("d")[i].as_py()
                listed = batch.column("anchors")[i].values
                a, maps = _Anchors(listed, d), batch.column("maps")[i].as_py()
                lo, hi = (np.frombuffer(b"".join(m[c] for m in maps), "<i4").reshape(len(maps), d).astype(float) for c in ("lo", "hi"))
                meets = _chosen(a, lo, hi, [m["kinds"] for m in maps], same)
                if meets.any():
                    wanted = [False] * (max(m["pos"] for m in maps) + 1)
                    for m, any_ in zip(maps, meets.any(0).tolist()):
                        wanted[m["pos"]] = any_
                    bits = np.zeros((len(wanted), a.n), np.uint8)
                    bits[[m["pos"] for m in maps]] = meets.T
                    out.append((batch.column("other")[i].as_py(), i, wanted, np.packbits(bits, axis=1).tobytes()))
            if out:
                took = pa.array([o[1] for o in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), batch.column("anchors").take(took), pa.array([o[2] for o in out], pa.list_(pa.bool_())), pa.array([o[3] for o in out], pa.binary())],
                    ["zone", "anchors", "wanted", "mask"],
                )

    return run


# ---- reading blocks ---------------------------------------------------------------------------------


class _Best:
    """The best ``k`` rows of every (anchor, window) so far."""

    def __init__(self, k: int, pending: int):
        self.k, self.pending, self.held, self.size = k, pending, [], 0

    def add(self, *columns) -> None:
        self.held.append(columns)
        self.size += len(columns[0])

    def reduced(self):
        uid, window, score, vec_id = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((vec_id, -score, window, uid))
        uid, window, score, vec_id = uid[order], window[order], score[order], vec_id[order]
        fresh = np.ones(len(uid), bool)
        fresh[1:] = (uid[1:] != uid[:-1]) | (window[1:] != window[:-1])
        rank = np.arange(len(uid)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        keep = rank < self.k
        return uid[keep], window[keep], score[keep], vec_id[keep]

    def flush(self, end: bool = False):
        """What to send on now, if anything."""
        if not self.size or (self.size < self.pending and not end):
            return None
        columns = self.reduced()
        if end or len(columns[0]) > self.pending // 2:
            self.held, self.size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(columns[2]), pa.array(columns[3])], ["uid", "slot", "score", "vec_id"])
        self.held, self.size = [columns], len(columns[0])
        return None


def _read(same: bool, k: int, pending: int = PENDING):
    """(block, anchors that read it) to the anchors' best rows in each window."""

    def run(batches):
        best = _Best(k, pending)
        for batch in batches:
            for i in range(batch.num_rows):
                d = batch.column("d")[i].as_py()
                a = _Anchors(batch.column("anchors")[i].values, d)
                ids, labels = (np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in ("ids", "labels"))
                z = np.frombuffer(batch.column("z")[i].as_py(), "<i4").reshape(len(ids), d).astype(float)
                mask = batch.column("mask")[i].as_py()
                asks = np.arange(a.n)
                if mask is not None:
                    own = np.frombuffer(mask, np.uint8).reshape(-1, -(-a.n // 8))[batch.column("pos")[i].as_py()]
                    asks = np.flatnonzero(np.unpackbits(own, count=a.n))
                if not len(asks):
                    continue
                score = a.z[asks] @ z.T
                fits = ((labels == a.label[asks, None]) == same) & (ids != a.vec_id[asks, None])
                # Scores with the row's place in the block, which follows the id: all different.
                ranked = score.astype(np.int64) * MOST + (MOST - 1 - np.arange(len(ids)))
                for w in range(a.low.shape[1]):
                    inside = fits & (score >= a.low[asks, w, None]) & (score <= a.high[asks, w, None])
                    if not inside.any():
                        continue
                    if len(ids) > k:
                        only = np.where(inside, ranked, np.iinfo(np.int64).min)
                        least = np.partition(only, len(ids) - k, axis=1)[:, len(ids) - k]
                        inside &= only >= least[:, None]
                    r, c = np.nonzero(inside)
                    best.add(a.uid[asks[r]], np.full(len(r), w), score[r, c].astype(np.int64), ids[c])
                if (out := best.flush()) is not None:
                    yield out
        if (out := best.flush(end=True)) is not None:
            yield out

    return run


_FOUND = "uid long, slot int, score long, vec_id long"


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _by_zone(anchors: DataFrame) -> DataFrame:
    """One row a zone with all its anchors, at most a zone's rows."""
    return anchors.groupBy("zone", "d").agg(F.collect_list(F.struct("uid", "vec_id", "label", "z", "low", "high")).alias("anchors"))


_PAYLOAD = "array<struct<uid: long, vec_id: long, label: long, z: binary, low: array<double>, high: array<double>>>"


def _search(anchors: DataFrame, blocks: DataFrame, maps: DataFrame, buckets: int, same: bool, k: int) -> DataFrame:
    """(uid, slot, score, vec_id, rank) of the ``k`` best fitting rows of every anchor in each of its windows.

    ``anchors`` holds ``_ANCHOR`` with lists ``low`` and ``high``, the windows of scores.
    """
    # The own zone first: the last of its results is a score that the last of all reaches.
    asked = cut_lineage(_by_zone(anchors), "negatives-anchors")
    whole = ["zone", "pos", "d", "ids", "labels", "z"]
    near = blocks.select(*whole).join(asked.select("zone", "anchors", F.lit(None).cast("binary").alias("mask")), "zone")
    floor = _first(near.mapInArrow(_read(same, k), _FOUND), k).filter(F.col("rank") == k)
    floor = floor.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floor"))
    raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at(F.col("floor"), i).cast("double"), x)))
    higher = anchors.join(floor, "uid", "left").withColumn("low", F.when(F.col("floor").isNull(), F.col("low")).otherwise(raised)).drop("floor")
    asked = cut_lineage(_by_zone(higher), "negatives-anchors")
    sent = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).drop("zone")
    pairs = sent.join(maps, ["bucket", "d"]).select("d", "anchors", "other", "maps")
    chosen = pairs.mapInArrow(_choose(same), f"zone long, anchors {_PAYLOAD}, wanted array<boolean>, mask binary")
    read = chosen.join(blocks.select(*whole), "zone").filter(F.element_at("wanted", F.col("pos") + 1))
    return _first(read.drop("wanted").mapInArrow(_read(same, k), _FOUND), k)


def zone_maps(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(other, d, bucket, maps): the zone maps of each zone's blocks, and the number of buckets."""
    zones = blocks.groupBy("zone", "d").agg(F.sort_array(F.collect_list(F.struct("pos", "lo", "hi", "kinds"))).alias("maps"))
    zones = cut_lineage(zones.withColumnRenamed("zone", "other"), "negatives-zones")
    buckets = max(1, -(-zones.count() // BUCKET_ZONES))
    return zones.withColumn("bucket", F.pmod(F.xxhash64("other"), F.lit(buckets)).cast("int")), buckets


def mine(
    rows: DataFrame, anchor: Column, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, block_rows: int = BLOCK_ROWS, zone_blocks: int = ZONE_BLOCKS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` marks."""
    conf, limit = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(limit)
    try:
        conf.set(limit, str(BATCH_ROWS))
        blocks = write_blocks(rows_of(rows, anchor, F.col("label") if label is None else label, id_col, vector_col), block_rows, zone_blocks)
        conf.set(limit, str(BATCH_BLOCKS))
        return cut_lineage(_mined(blocks, positives, negatives), "negatives")
    finally:
        conf.set(limit, before)


def _mined(blocks: DataFrame, positives: int, negatives: int) -> DataFrame:
    maps, buckets = zone_maps(blocks)
    anchors = cut_lineage(blocks.select("zone", "pos", "d", "ids", "labels", "anchors", "z").mapInArrow(_list_anchors, _ANCHOR), "negatives-anchors")
    wide = {side: F.array(F.lit(value)) for side, value in (("low", float("-inf")), ("high", float("inf")))}
    found = _search(anchors.withColumns(wide), blocks, maps, buckets, True, positives)
    found = found.select("uid", F.col("rank").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = cut_lineage(found, "negatives-positives")
    # Whole numbers throughout: the least score at or above LOW percent and the greatest at or below HIGH percent.
    part = lambda percent: f"({percent} * positive_score - pmod({percent} * positive_score, 100)) div 100"
    window = F.struct("positive", F.expr(f"-({part(-LOW)})").cast("double").alias("low"), F.expr(part(HIGH)).cast("double").alias("high"))
    inside = found.groupBy("uid").agg(F.sort_array(F.collect_list(window)).alias("p"))
    windows = anchors.join(inside, "uid").select(*anchors.columns, F.col("p.low").alias("low"), F.col("p.high").alias("high"))
    negative = _search(windows, blocks, maps, buckets, False, negatives)
    named = anchors.select("uid", F.col("vec_id").alias("anchor_id")).join(found, "uid")
    out = negative.withColumn("positive", F.col("slot") + 1).join(named, ["uid", "positive"])
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100; where it is divisible by 7 the label is the next of ten."""
    rows = ensure_session(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    v = F.col("vec_id")
    label = F.when(v % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows, v % 100 == 0, label)


SQL = f"""WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS z
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.z, b.z) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}"""
