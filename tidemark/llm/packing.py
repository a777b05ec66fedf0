"""Token rows packed by best fit decreasing, and their binary matrices.

Documents' ids are cut into pieces of at most ``length`` tokens, without loss:
full pieces are rows of their own, and remainders are packed into rows by best
fit decreasing. The row with the least sufficient capacity is found in a
segment tree over capacities, in log(length) steps per piece. Packing runs
where the ids are: a task packs them in groups of about ``GROUP_TOKENS``
tokens and one document, so nothing is shuffled, no group grows with the
corpus, and at most the last rows of a group stay partly empty.

Every row is one line of an id matrix (``length`` little-endian unsigned 32-bit
ids, padded), with the cumulative lengths of its segments, the position of each
token in its segment (starting from 0 again at each, 0 in the padding), and the
document and offset each segment comes from.

Defined results: a document without ids (null or empty text) is in no row;
repeated rows are packed once each; a null key stays a null key; ties go to the
piece that came first and the row that was opened last.
"""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tidemark.llm.bpe import read_ranks
from tidemark.llm.common import batched, documents, id_text, once, slices, texts

LENGTH = 2048
GROUP_TOKENS = 1 << 22
PAD = 50256  # free in the vocabulary


class Capacities:
    """A segment tree over free capacities 0..length that finds the least one of an open row."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = self.size + capacity
        while at:
            self.tree[at] += 1
            at //= 2

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of the fullest row with at least ``least`` free, which is removed."""
        at = self.size + least
        if not self.tree[at]:
            # Up to the first right neighbour that holds a row, then down its leftmost path.
            while at > 1 and (at % 2 or not self.tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at *= 2
                if not self.tree[at]:
                    at += 1
        capacity = at - self.size
        while at:
            self.tree[at] -= 1
            at //= 2
        return capacity, self.rows[capacity].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Numbers of the pieces in each row; every size is from 1 to ``length``."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = free.take(sizes[piece])
        if found is None:
            found = length, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(piece)
        if capacity > sizes[piece]:
            free.add(capacity - sizes[piece], row)
    return rows


def _rows(keys: list, ids: list[np.ndarray], length: int, pad: int):
    """The packed rows of a group: (matrix row, cumulative lengths, positions, documents, offsets)."""
    pieces = [(d, s, min(length, len(v) - s)) for d, v in enumerate(ids) for s in range(0, len(v), length)]
    for row in best_fit([n for _, _, n in pieces], length):
        line, positions = np.full(length, pad, "<u4"), np.zeros(length, "<u4")
        ends, at = [0], 0
        for p in row:
            d, start, n = pieces[p]
            line[at : at + n] = ids[d][start : start + n]
            positions[at : at + n] = np.arange(n)
            at += n
            ends.append(at)
        yield line.tobytes(), ends, positions.tobytes(), [keys[pieces[p][0]] for p in row], [pieces[p][1] for p in row]


def _packer(kind: DataType, length: int, pad: int, group_tokens: int):
    """Batches of (doc_id, ids) to batches of packed rows."""
    schema = pa.schema(
        [("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("positions", pa.binary()), ("doc_ids", pa.list_(to_arrow_type(kind))), ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.int32())]
    )

    def batch_of(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*[pa.array(c, f.type) for c, f in zip(columns, schema)], pa.array([r[1][-1] for r in rows], pa.int32())], schema=schema)

    def packed(keys, ids):
        rows = []
        for row in _rows(keys, ids, length, pad):
            rows.append(row)
            if len(rows) == 256:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def run(batches):
        keys, ids, size = [], [], 0
        for batch in batches:
            for key, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                own = np.frombuffer(data.as_py() or b"", "<u4")
                keys.append(key)
                ids.append(own)
                size += len(own)
                if size >= group_tokens:
                    yield from packed(keys, ids)
                    keys, ids, size = [], [], 0
        yield from packed(keys, ids)

    return run


def _packed_schema(kind: DataType) -> str:
    return f"ids binary, cu_seqlens array<int>, positions binary, doc_ids array<{kind.simpleString()}>, offsets array<long>, n_tokens int"


def pack(encoded: DataFrame, length: int = LENGTH, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Rows of ``length`` tokens from (doc_id, ids): ids, cu_seqlens, positions, doc_ids, offsets, n_tokens.

    Segment i holds tokens ``cu_seqlens[i]`` to ``cu_seqlens[i + 1]``: the tokens
    of document ``doc_ids[i]`` from its ``offsets[i]``.
    """
    kind = encoded.schema["doc_id"].dataType
    return batched(encoded).select("doc_id", "ids").mapInArrow(_packer(kind, length, pad, group_tokens), _packed_schema(kind))


def pack_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """As :func:`pack`, of texts that are encoded where they are read, one after the other."""
    rows = id_text(docs, id_col, text_col)
    kind, name = rows.schema["doc_id"].dataType, uuid4().hex
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    pack_all = _packer(kind, length, pad, group_tokens)

    def encoded(batches):
        encoder = once("packing", name, lambda: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={}))
        for batch in slices(batches):
            ids = [encoder.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(lambda batches: pack_all(encoded(batches)), _packed_schema(kind))


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write the rows: the id and position columns of a file, read in order, are its matrices line by line."""
    packed.write.option("compression", "zstd").parquet(path)


def matrix(rows, column: str = "ids") -> np.ndarray:
    """Collected rows as a matrix, one packed row a line."""
    return np.stack([np.frombuffer(r[column], "<u4") for r in rows])


def query(spark, sf_dir: str) -> DataFrame:
    """All documents as packed rows of the byte-level vocabulary."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pack_texts(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
