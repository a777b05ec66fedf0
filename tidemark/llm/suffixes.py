"""Passages repeated across documents, by sparse suffix arrays.

Words are A-Z lower-cased. A suffix is retained where a minimiser selects it:
the least hash of ``SEED_WORDS`` words among each run of neighbouring starts that
a passage of ``MIN_WORDS`` words is sure to hold. Both copies of such a passage
retain the same suffix, about one word in eleven in all.

Suffixes whose seed stands in one document only are dropped. The others are
sorted by seed, by the words after it and by the words before it, in ranges
that split also a seed which a third of all documents share. Neighbours of
different documents are compared and their match is extended left and right. A
suffix that matches a neighbour as far as its own text reaches (within the
least passage) is settled. The others may match different documents to the left
and to the right; each of their windows of ``MIN_WORDS`` words is counted, with
those of the suffixes they share a seed with, which makes the result exact: a
word is reported if and only if it lies in a window of ``MIN_WORDS`` words that
stands in two documents. No group of suffixes is paired up or gathered.

Defined results: one row per distinct document (key and text) with a repeated
passage, so repeated rows count once and don't repeat themselves; null and
empty texts and those below ``MIN_WORDS`` words have none; rows with a null key
are told apart by their text. Words are compared by 32-bit hashes beyond a
64-bit hash of the seed. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from tidemark.llm.common import SLICE_BYTES, documents, id_text, mix, slices, texts
from tidemark.session import cut_lineage

MIN_WORDS = 50
SEED_WORDS = 30
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _words(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words per row)."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in rows]
    coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    hashes = np.array([xxh64_intdigest(w, 7) for w in coded.dictionary.to_pylist()], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(rows))
    return (hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, np.uint64)), sizes


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def seeds(hashes: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the ``seed`` words from each start."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64)])
        n = len(hashes) - seed + 1
        return mix((sums[seed:] - sums[:n]) * _powers(_INVERSE, n))


def minimisers(keys: np.ndarray, width: int) -> np.ndarray:
    """Starts with the least key of some ``width`` neighbouring starts (the first of equal ones)."""
    if len(keys) < width:
        return np.zeros(0, np.int64)
    picked = np.zeros(len(keys), bool)
    for at in range(0, len(keys) - width + 1, 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(keys[at : at + (1 << 16) + width - 1], width)
        picked[at + np.arange(len(view)) + view.argmin(axis=1)] = True
    return np.flatnonzero(picked)


def _retained(seed: int, width: int):
    def run(batches):
        for batch in slices(batches):
            hashes, sizes = _words(texts(batch))
            names = batch.column("name").to_numpy()
            ends = np.cumsum(sizes)
            keys, at, name = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row in np.flatnonzero(sizes >= seed + width - 1):
                own = seeds(hashes[ends[row] - sizes[row] : ends[row]], seed)
                picked = minimisers(own, width)
                keys.append(own[picked])
                at.append(picked)
                name.append(np.full(len(picked), names[row]))
            columns = [np.concatenate(keys).view(np.int64), np.concatenate(name), np.concatenate(at).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "name", "at"])

    return run


def _zipped(batches):
    """Texts compressed for the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in slices(batches):
        packed = pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("name"), packed], ["doc_id", "name", "packed"])


def _unzipped(batches, limit: int = SLICE_BYTES):
    """(rows, their texts) in slices that end where their texts reach ``limit`` bytes; packed sizes don't bound those."""
    unzip = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        start, held, rows = 0, 0, []
        for end, packed in enumerate(batch.column("packed"), 1):
            text = unzip(packed.as_py())
            rows.append(text.decode("utf-8", "surrogatepass"))
            held += len(text)
            if held >= limit or end == batch.num_rows:
                yield batch.slice(start, end - start), rows
                start, held, rows = end, 0, []


def _contexts(seed: int, reach: int):
    """Rows (doc_id, name, packed text, starts) to retained suffixes with the words after and before the seed."""

    def run(batches):
        for batch, rows in _unzipped(batches):
            hashes, sizes = _words(rows)
            ends = np.cumsum(sizes)
            out: list[list] = [[], [], [], [], []]
            for row, starts in enumerate(batch.column("starts")):
                own = hashes[ends[row] - sizes[row] : ends[row]]
                short = (own >> np.uint64(32)).astype(">u4")
                forward, backward, n = short.tobytes(), short[::-1].tobytes(), len(own)
                keys = seeds(own, seed).view(np.int64)
                for at in np.unique(starts.values.to_numpy()).tolist():
                    out[0].append(row)
                    out[1].append(keys[at])
                    out[2].append(at)
                    out[3].append(forward[4 * (at + seed) : 4 * (at + seed + reach)])
                    out[4].append(backward[4 * (n - at) : 4 * (n - at + reach)])
            taken = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(taken), batch.column("name").take(taken), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())],
                ["doc_id", "name", "key", "at", "after", "before"],
            )

    return run


def common(a: bytes, b: bytes) -> int:
    """Equal leading words (4 bytes each)."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 4
    low, high = 0, n // 4  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[: 4 * middle] == b[: 4 * middle]:
            low = middle
        else:
            high = middle
    return low


# A suffix as it is compared: (key, words after the seed, words before it, document's name, start, document's key).
SUFFIX = ("key", "after", "before", "name", "at", "doc_id")
# Settled suffixes of a seed that wait to see whether an unsettled one follows.
_WAITING_RUNS = 1000


class _Seed:
    """The suffixes of one seed, which come sorted by the words after it and before it."""

    def __init__(self, key, edge: bool, seed: int, least: int):
        self.key, self.seed, self.least = key, seed, least
        self.edge = edge  # the seed may go on in the neighbouring range, with suffixes not seen here
        self.other = None  # the last suffix of another document than the latest one's
        self.latest: list[tuple] = []  # the latest document's suffixes, each with its match to ``other``
        self.runs: list[tuple] = []  # one suffix of each settled run
        self.words = None  # those of the last settled run
        self.unsettled = False

    def match(self, a: tuple, b: tuple) -> tuple[int, int, bool]:
        """(words equal on the left, on the right, whether they reach as far as the text of ``a``)."""
        left, right = common(a[2], b[2]), common(a[1], b[1])
        return left, right, 4 * left == len(a[2]) and 4 * right == len(a[1])

    def add(self, row: tuple):
        """Rows to put out because a suffix of another document has come."""
        if self.latest and self.latest[-1][0] == row:
            return  # of a repeated row
        if self.latest and self.latest[-1][0][3] != row[3]:
            yield from self.settle(row)
        self.latest.append((row, self.match(row, self.other) if self.other else (0, 0, False)))

    def settle(self, later: tuple | None):
        """The latest document's suffixes, now that both their neighbours are known."""
        for row, best in self.latest:
            if later is not None:
                best = max(best, self.match(row, later), key=lambda m: (m[2], m[0] + m[1]))
            yield from self.put(row, *best)
        if self.latest:
            self.other, self.latest = self.latest[-1][0], []

    def put(self, row: tuple, left: int, right: int, settled: bool):
        """The span of a suffix, and the suffix itself where its windows may have to be counted."""
        found = left + self.seed + right >= self.least
        yield (*row, row[4] - left if found else None, row[4] + self.seed + right if found else None, settled, False)
        if not settled:
            self.unsettled = True
            yield from self.counted()
            yield (*row, None, None, False, True)
        elif self.words != row[1:3]:
            self.words = row[1:3]
            self.runs.append(row)
            if self.unsettled or self.edge or len(self.runs) > _WAITING_RUNS:
                yield from self.counted()

    def counted(self):
        yield from ((*r, None, None, True, True) for r in self.runs)
        self.runs = []


def _neighbours(seed: int, least: int, id_type: pa.DataType):
    """Sorted suffixes to spans (start, end) found by extension and, where a seed's suffixes aren't all settled
    (or may not be in the next range), one suffix of each settled run and each unsettled suffix to count windows of."""
    schema = pa.schema(
        [("key", pa.int64()), ("after", pa.binary()), ("before", pa.binary()), ("name", pa.int64()), ("at", pa.int32()), ("doc_id", id_type)]
        + [("start", pa.int32()), ("end", pa.int32()), ("settled", pa.bool_()), ("counts", pa.bool_())]
    )

    def batch_of(rows):
        # Words only where windows are counted.
        rows = [r if r[9] else (r[0], None, None, *r[3:]) for r in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        group, out = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in SUFFIX)):
                if group is None or row[0] != group.key:
                    if group is not None:
                        out.extend(group.settle(None))
                    group = _Seed(row[0], group is None, seed, least)
                out.extend(group.add(row))
            if len(out) > 4096:
                yield batch_of(out)
                out = []
        if group is not None:
            group.edge = True
            out.extend(group.settle(None))
            out.extend(group.counted())
        if out:
            yield batch_of(out)

    return run


def _windows(seed: int, least: int):
    """Every window of ``least`` words around the seed of a suffix, as a hash of its words and the seed's place."""

    def run(batches):
        for batch in batches:
            rows, hashes, starts = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("key", "after", "before", "at")]
            for i, (key, after, before, at) in enumerate(zip(*columns)):
                for left in range(max(0, least - seed - len(after) // 4), min(least - seed, len(before) // 4) + 1):
                    rows.append(i)
                    hashes.append(xxh64_intdigest(before[: 4 * left] + after[: 4 * (least - seed - left)], (key + left) % (1 << 64)))
                    starts.append(at - left)
            taken = batch.select(["doc_id", "name", "settled"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(starts, pa.int32())], ["doc_id", "name", "settled", "window", "start"])

    return run


def _merged(batches):
    """The spans of a document to their union, in order."""
    for batch in batches:
        lists = []
        for spans in batch.column("spans"):
            out: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in spans.as_py()):
                if out and start <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], end)
                else:
                    out.append([start, end])
            lists.append([{"start": s, "end": e} for s, e in out])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        words = pa.array([sum(s["end"] - s["start"] for s in spans) for spans in lists], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), words, pa.array(lists, kind)], ["doc_id", "n_words", "spans"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """(doc_id, n_words, spans) of every document with a passage of ``min_words`` words that another document has.

    ``spans`` are word ranges (ends exclusive), ``n_words`` the words in them.
    """
    if not 0 < seed_words <= min_words:
        raise ValueError("a seed is no longer than the least passage")
    reach = min_words - seed_words
    rows = id_text(docs, id_col, text_col).filter("text IS NOT NULL").withColumn("name", F.xxhash64("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Stored once, read by the count and by the join, whose side with the suffixes adaptive execution splits where a seed is hot.
    retained = cut_lineage(rows.select("name", "text").mapInArrow(_retained(seed_words, reach + 1), "key long, name long, at int"), "suffix-starts")
    shared = retained.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a != b").select("key")
    shared = cut_lineage(shared, "suffix-seeds")
    # Sets, here and of the spans: repeated rows share a name, and each of them gets the list.
    starts = retained.join(shared, "key").groupBy("name").agg(F.collect_set("at").alias("starts"))
    sent = rows.mapInArrow(_zipped, f"doc_id {kind}, name long, packed binary").join(starts, "name")
    suffixes = sent.mapInArrow(_contexts(seed_words, reach), f"doc_id {kind}, name long, key long, at int, after binary, before binary")
    order = ["key", "after", "before", "name", "at"]
    # A fixed number of ranges: merged by size they would be uneven in rows, as equal suffixes compress to nothing.
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Bounds need the seed first, so that its parts are neighbours, and then anything that splits a hot one; they are short,
    # as samples of them reach the driver.
    bounds = ["key", F.substring("after", 1, 8), F.substring("before", 1, 8), F.xxhash64("after", "before"), "name"]
    ranged = cut_lineage(suffixes, "suffixes").repartitionByRange(ranges, *bounds).sortWithinPartitions(*order)
    compared = ranged.select(*SUFFIX).mapInArrow(
        _neighbours(seed_words, min_words, to_arrow_type(rows.schema["doc_id"].dataType)),
        f"key long, after binary, before binary, name long, at int, doc_id {kind}, start int, end int, settled boolean, counts boolean",
    )
    compared = cut_lineage(compared, "suffix-neighbours")
    spans = compared.filter("start IS NOT NULL").select("doc_id", "name", "start", "end")
    windows = compared.filter("counts").select("doc_id", "name", "settled", "key", "at", "after", "before")
    windows = cut_lineage(windows.mapInArrow(_windows(seed_words, min_words), f"doc_id {kind}, name long, settled boolean, window long, start int"), "suffix-windows")
    again = windows.groupBy("window").agg(F.min("name").alias("a"), F.max("name").alias("b"), F.bool_or("settled").alias("several")).filter("a != b OR several").select("window")
    more = windows.filter("NOT settled").join(again, "window").select("doc_id", "name", "start", (F.col("start") + min_words).alias("end"))
    found = spans.unionByName(more).groupBy("doc_id", "name").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return found.select("doc_id", "spans").mapInArrow(_merged, f"doc_id {kind}, n_words long, spans array<struct<start:int,end:int>>")


def query(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents."""
    return repeated_passages(documents(spark, sf_dir))
