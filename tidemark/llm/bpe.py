"""Byte-level BPE over a global shuffle of distinct words.

Texts are cut into pre-tokens (words) with their positions, in blocks of
bounded size. A block sends each of its distinct words once to the word's part;
there each distinct word is encoded once, whatever the number of blocks that
hold it, and its ids go back to the blocks. A block then puts the ids in place
by position. The words, their positions and the ids travel packed (many to a
row, compressed), so the shuffles are smaller than the texts. Decoding joins
the ids with the table of token bytes, which every worker holds.

A frequent word is one entry per block, not one per occurrence, and a hot
source's rows stay in the blocks where they were read. A block is named by a
hash of its place (task and number in the task), its words and its positions:
blocks of equal texts keep apart, so that a group is one block, and were a lost
block rebuilt from rows in another order, the job would fail and not mix up ids.

Defined results: a null or empty text has no ids; repeated rows give repeated
results; other columns are not read. The ranks and the pattern are parameters.
"""

from __future__ import annotations

import base64
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from tidemark.llm.common import documents, id_text, once, slices, texts

BLOCK_BYTES = 8 << 20
# Pre-tokens held as objects at a time, and the length of a text whose pre-tokens are not listed at once.
CHUNK_WORDS = 1 << 17
LONG_TEXT = 1 << 20
# Parts per shuffle partition: they are dealt by hash, so several even out.
PARTS = 4
_BLOCK_NAME = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a tiktoken file (a vocabulary: its size does not depend on the corpus)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """The arrays, each after its size in bytes, compressed."""
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x for p in parts for x in (len(p).to_bytes(8, "little"), p)))


def _unpack(packed: bytes) -> list[bytes]:
    data, out, at = zstandard.ZstdDecompressor().decompress(packed), [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values with the bytes of each rank together, which compress better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [data[s:e] for s, e in zip([0, *ends], ends)]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]``, one after another."""
    before = np.cumsum(sizes, dtype=np.int64) - sizes
    at = np.repeat((starts - before).astype(np.int64 if len(flat) >> 31 else np.int32), sizes)
    at += np.arange(len(at), dtype=at.dtype)
    return flat[at]


def pre_tokens(pattern, rows: list[str]) -> tuple[np.ndarray, list[bytes], list[int]]:
    """(number of the word at every position, the distinct words, positions per row)."""
    chunks, pending, sizes = [], [], []

    def flush():
        chunks.append(pa.array(pending, pa.string()).dictionary_encode())
        pending.clear()

    for text in rows:
        before = sum(map(len, chunks)) + len(pending)
        if len(text) <= LONG_TEXT:
            pending += pattern.findall(text)
        else:
            for match in pattern.finditer(text):
                pending.append(match[0])
                if len(pending) >= CHUNK_WORDS:
                    flush()
        if len(pending) >= CHUNK_WORDS:
            flush()
        sizes.append(sum(map(len, chunks)) + len(pending) - before)
    flush()
    flat = pa.chunked_array(chunks).unify_dictionaries()
    return np.concatenate([c.indices.to_numpy() for c in flat.chunks]), flat.chunk(0).dictionary.cast(pa.binary()).to_pylist(), sizes


def _split(pattern: str, parts: int, limit: int):
    """Rows to (key, words of a part) and (block's name, positions)."""
    compiled = regex.compile(pattern)

    def run(batches):
        task = TaskContext.get().partitionId()
        for ordinal, batch in enumerate(slices(batches, limit=limit)):
            indices, words, lengths = pre_tokens(compiled, texts(batch))
            part = np.fromiter((int.from_bytes(xxh64_digest(w)[:4], "big") for w in words), np.int64, len(words)) % parts
            order = np.argsort(part, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words))
            used, starts = np.unique(part[order], return_index=True)
            ends = [*starts[1:].tolist(), len(words)]
            ordered = [words[i] for i in order.tolist()]
            blobs = [_pack(np.array([len(w) for w in ordered[s:e]], "<u4"), b"".join(ordered[s:e])) for s, e in zip(starts.tolist(), ends)]
            at = _pack(_planes(place[indices]))
            name = _BLOCK_NAME | xxh64_intdigest(b"".join([b"%d %d " % (task, ordinal), *blobs, at])) >> 2
            n = len(blobs)
            ids = batch.column("doc_id")
            lists = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(ids)], pa.int32()), ids)
            sizes = pa.array([None] * n + [lengths], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*used.tolist(), name], pa.int64()), pa.array([name] * (n + 1), pa.int64()), pa.array([*blobs, at], pa.binary()), lists, sizes],
                ["key", "block", "data", "ids", "sizes"],
            )

    return run


def _encode_words(name: str, pattern: str, shared):
    """Rows of words to rows of their ids, keyed by block; each distinct word of a part is encoded once."""

    def run(batches):
        encoder = once("bpe", name, lambda: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={}))
        known: dict[bytes, tuple[int, bytes]] = {}
        for batch in batches:
            for key, block, data in zip(*(batch.column(c) for c in ("key", "block", "data"))):
                part = key.as_py()
                if part >= _BLOCK_NAME:
                    continue
                sizes, joined = _unpack(data.as_py())
                out = []
                for word in _cut(joined, np.frombuffer(sizes, "<u4")):
                    if word not in known:
                        ids = encoder._encode_single_piece(word)
                        known[word] = (len(ids), np.array(ids, "<u4").tobytes())
                    out.append(known[word])
                blob = _pack(np.array([n for n, _ in out], "<u4"), _planes(np.frombuffer(b"".join(i for _, i in out), "<u4")))
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([part], pa.int64()), pa.array([blob], pa.binary())], ["key", "part", "data"])

    return run


def _place(key, blocks: pa.Table, encoded: pa.Table) -> pa.Table:
    """The documents of a block with their ids, from its positions and its words' ids."""
    schema = pa.schema([("doc_id", blocks.schema.field("ids").type.value_type), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    out = []
    if key[0].as_py() >= _BLOCK_NAME:
        by_part = dict(zip(encoded["part"].to_pylist(), encoded["data"].to_pylist()))
        unpacked = [_unpack(by_part[p]) for p in sorted(by_part)]
        counts = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(n, "<u4") for n, _ in unpacked]]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, "<u4"), *[_from_planes(i) for _, i in unpacked]])
        starts = (np.cumsum(counts, dtype=np.int64) - counts).astype(np.int64 if len(flat) >> 31 else np.int32)
        for row in range(blocks.num_rows):
            ids, words = blocks["ids"][row].values, np.array(blocks["sizes"][row].as_py(), np.int64)
            at = _from_planes(_unpack(blocks["data"][row].as_py())[0])
            tokens = counts[at]
            sums = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
            ends = sums[np.cumsum(words)]
            sizes = np.diff(ends, prepend=0)
            data = gather(flat, starts[at], tokens).tobytes()
            out.append(pa.record_batch([ids, pa.array(sizes, pa.int64()), pa.array(_cut(data, sizes * 4), pa.binary())], schema=schema))
    return pa.Table.from_batches(out, schema=schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ids are little-endian unsigned 32-bit integers."""
    rows = id_text(docs, id_col, text_col)
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = _split(pattern, partitions * PARTS, block_bytes)
    # Words go to their part and positions to their block's place in one exchange, which both readers use.
    sent = rows.mapInArrow(split, f"key long, block long, data binary, ids array<{kind}>, sizes array<int>").repartition(partitions, "key")
    shared = spark.sparkContext.broadcast(ranks)
    encoded = sent.mapInArrow(_encode_words(uuid4().hex, pattern, shared), "key long, part long, data binary").repartition(partitions, "key")
    return sent.groupBy("key").cogroup(encoded.groupBy("key")).applyInArrow(_place, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids; a null stays null."""
    size = max(ranks.values(), default=-1) + 1
    table = [b""] * size
    for token, rank in ranks.items():
        table[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        token = shared.value.__getitem__
        for batch in slices(batches, ids_col):
            done = [None if i is None else b"".join(map(token, np.frombuffer(i, "<u4").tolist())) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.binary())], [*batch.schema.names, name])

    return encoded.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields], f"{name} binary"]))


def query(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents and what they decode to, as digests."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = decode(encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
