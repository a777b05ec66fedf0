"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The tokens of a text are its words (A-Z lower-cased) and one end. Training
counts all tokens and all pairs of neighbouring tokens of all training texts;
a row starts after an end. Every counted word and pair enters the filter, those
seen once too, so the filter grows with the corpus. A count enters as a level,
the bit length of the count; an n-gram of level l is stored as l members
(n-gram, 1) to (n-gram, l), and a reader probes them in turn until one is
missing. A level stands for the least count that has it.

The filter lies in shards: an n-gram belongs to the shard its key's hash names,
and a shard is sized from its own members. Shards number at least one per
``SHARD_TOKENS`` training tokens, so a shard is bounded; they are built, stored
and probed by Spark, and neither the driver nor a broadcast holds them. Scoring
cuts the texts into blocks. A block asks each shard once for its distinct words
and pairs; the levels go back to the block, which puts them in place by position.

A token's probability interpolates the pair's with the word's:
P(b|a) = L * r(ab) / c(a) + (1 - L) * P(b), and P(b) = r(b) / (R + 1) where a is
in no training text; r are quantised counts, R adds up those of all words, c(a)
is exact. All unseen words together count as a single occurrence. As r is never
above c, the probabilities after a word add up to 1 at most, but for the filter's
false positives, some 0.6 % of the probes of absent n-grams.

The add-one base score needs exact counts: a shard also holds its words with
their counts, and answers for them by the word itself, not by its hash.

Defined results: a null or empty text is its end alone; repeated rows give
repeated results; without training texts every probability is 1; an empty table
gives no rows. A text longer than a block is a block of its own, held by one
task. A block is named by its task and place, so score stored rows: an input
computed anew in another order after a lost executor finds no answers and fails.
Other columns of the input are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64, xxh64_intdigest

from tidemark.llm.bpe import _cut, _from_planes, _pack, _planes, _unpack
from tidemark.llm.common import batched, documents, fold, id_text, mix, slices, texts
from tidemark.session import cut_lineage

END = b"\n"
BIGRAM_WEIGHT = 0.5
BITS_PER_MEMBER = 14
HASHES = 5
BLOCK_BYTES = 4 << 20
SHARD_TOKENS = 1 << 20
# Shards per shuffle partition, at least: they are dealt by hash, so several even out.
SHARDS = 4
# Words and pairs that a task holds before it sends them or adds equal ones up.
PENDING_WORDS, PENDING_PAIRS = 1 << 17, 1 << 22
LEVELS = 64
# With fewer slots members would crowd in some.
LEAST_SLOTS = 256
# Requests of a shard that are probed together, and keys whose arrays stay in a core's cache.
TOGETHER, PROBED = 64, 1 << 13
# Bytes of a key inside a shard: two of a million n-grams agree in them once in some 500 shards.
KEY_BYTES = 6
_KEY = np.uint64((1 << 8 * KEY_BYTES) - 1)
_UNIGRAM, _BIGRAM = 1, 2
_BLOCK_NAME = 1 << 62


def tokens(rows: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of every token, the distinct tokens by code, tokens per row)."""
    words = [[*t.encode("utf-8", "surrogatepass").lower().split(), END] for t in rows]
    coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.fromiter(map(len, words), np.int64, len(rows))


def _count(batches):
    for batch in slices(batches, limit=2 << 20):
        codes, distinct, _ = tokens(texts(batch))
        yield pa.RecordBatch.from_arrays([distinct.cast(pa.string()), pa.array(np.bincount(codes, minlength=len(distinct)), pa.int64())], ["word", "n"])


def slots_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and step of a key's slots, one a level, and the bits it has in each of them."""
    spread = mix(keys, 2)
    return mix(keys, 1), spread | np.uint64(1), spread


def slot(start: np.ndarray, step: np.ndarray, level: int, slots: int) -> np.ndarray:
    """The slot of the members (key, level), by the upper half of a product instead of a division."""
    with np.errstate(over="ignore"):
        return (((start + step * np.uint64(level)) >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)


def bit(spread: np.ndarray, i: int) -> np.ndarray:
    """The i-th bit of a key in its slots of 64."""
    return (spread >> np.uint64(4 + 6 * i)) & np.uint64(63)


def filter_of(keys: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A filter with the members (key, 1) to (key, level), as slots of 64 bits."""
    slots = max(LEAST_SLOTS, -(-int(level.sum()) * BITS_PER_MEMBER // 64))
    mark, hashed = np.zeros(slots * 64, bool), slots_of(keys)
    for member in range(1, int(level.max(initial=0)) + 1):
        start, step, spread = (h[level >= member] for h in hashed)
        first = slot(start, step, member, slots) * np.uint64(64)
        for i in range(HASHES):
            mark[first + bit(spread, i)] = True
    return np.packbits(mark, bitorder="little").view("<u8")


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a, _BIGRAM) ^ b, _BIGRAM)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards by the upper half of the keys; inside a shard the lower ``KEY_BYTES`` tell n-grams apart."""
    return ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """The lower bytes of ascending keys as differences, the bytes of each rank together."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(steps[:, :KEY_BYTES].T).tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    steps = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    steps[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(KEY_BYTES, -1).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _levels(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Levels of n-gram keys by repeated probes of their shard, one slot a level."""
    if len(keys) > PROBED:
        return np.concatenate([_levels(table, keys[s : s + PROBED]) for s in range(0, len(keys), PROBED)])
    out = np.zeros(len(keys), np.uint8)
    alive, level, (start, step, spread) = np.arange(len(keys)), 0, slots_of(keys)
    want = np.zeros(len(keys), np.uint64)
    for i in range(HASHES):
        want |= np.uint64(1) << bit(spread, i)
    while len(alive) and level < LEVELS - 1:
        level += 1
        inside = np.flatnonzero(table[slot(start, step, level, len(table))] & want == want)
        if len(inside) < len(alive):
            alive, start, step, want = (a.take(inside) for a in (alive, start, step, want))
        out[alive] = level
    return out


@dataclass
class Model:
    total: int  # training tokens
    types: int  # distinct training tokens
    shards: int
    filters: DataFrame  # stored (key, data): a shard's words, counts, bits and filter
    quantised: int  # what the words' quantised counts add up to


class _Shard:
    """A stored shard: exact counts of its words, levels of its words and pairs."""

    def __init__(self, data: bytes | None):
        sizes, joined, counts, table = _unpack(data) if data else [b""] * 4
        self.counts = dict(zip(_cut(joined, np.frombuffer(sizes, "<u4")), np.frombuffer(counts, "<i8").tolist()))
        self.table = np.frombuffer(table, "<u8")

    def levels(self, keys: np.ndarray) -> np.ndarray:
        return _levels(self.table, keys & _KEY) if len(self.table) else np.zeros(len(keys), np.uint8)


def lower_edges(levels: np.ndarray) -> np.ndarray:
    """The least count of each level; 0 for what is not in the filter."""
    return np.where(levels > 0, np.int64(1) << np.maximum(levels.astype(np.int64) - 1, 0), 0)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxh64_intdigest(w, 42) for w in words], np.uint64)


def _pairs(codes: np.ndarray, sizes: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of neighbouring tokens as codes (first, second), the pair at every position, the pairs' counts."""
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    before[np.cumsum(sizes) - sizes] = words.index(END)
    unique, at, times = np.unique(before * len(words) + codes, return_inverse=True, return_counts=True)
    return unique // len(words), unique % len(words), at, times


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(the order that puts keys of a shard together, by their lower bytes, and the shards in this order)."""
    shard = shard_of(keys, shards)
    order = np.lexsort((keys & _KEY, shard))
    return order, shard[order]


def _rows(used: np.ndarray, blobs: list[bytes], kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], ["key", "kind", "data"])


def _send_pairs(shards: int):
    """Texts to (shard, packed keys and counts of pairs)."""

    def run(batches):
        for batch in slices(batches, limit=BLOCK_BYTES):
            codes, distinct, sizes = tokens(texts(batch))
            words = distinct.to_pylist()
            first, second, _, times = _pairs(codes, sizes, words)
            hashes = _hashes(words)
            keys = pair_keys(hashes[first], hashes[second])
            order, shard = _dealt(keys, shards)
            keys, times = keys[order] & _KEY, times[order].astype("<u4")
            used, starts = np.unique(shard, return_index=True)
            ends = [*starts[1:].tolist(), len(keys)]
            yield _rows(used, [_pack(_pack_keys(keys[s:e]), _planes(times[s:e])) for s, e in zip(starts.tolist(), ends)], _BIGRAM)

    return run


def _send_words(shards: int):
    """Rows (word, n) to (shard, packed words and counts)."""

    def send(words, counts):
        counts = np.array(counts, "<i8")
        order, shard = _dealt(mix(_hashes(words), _UNIGRAM), shards)
        used, starts = np.unique(shard, return_index=True)
        parts = [order[s:e] for s, e in zip(starts, [*starts[1:], len(order)])]
        return _rows(used, [_pack(np.array([len(words[i]) for i in p], "<u4"), b"".join(words[i] for i in p), counts[p]) for p in parts], _UNIGRAM)

    def run(batches):
        words, counts = [], []
        for batch in batches:
            words += batch.column("word").cast(pa.binary()).to_pylist()
            counts += batch.column("n").to_pylist()
            if len(words) >= PENDING_WORDS:
                yield send(words, counts)
                words, counts = [], []
        if words:
            yield send(words, counts)

    return run


def _sum_up(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their counts."""
    key, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *times])
    order = np.argsort(key)
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[starts], np.add.reduceat(n, starts) if len(key) else n


def _build(batches):
    """Rows of shards, each shard's together, to one stored shard and the sum of its words' quantised counts."""
    now, words, sizes, counts, keys, times, held = None, [], [], [], [], [], 0

    def shard():
        own = np.concatenate([np.zeros(0, "<i8"), *counts])
        joined, lengths = b"".join(words), np.concatenate([np.zeros(0, "<u4"), *sizes])
        pairs, n = _sum_up(keys, times)
        grams = np.concatenate([mix(_hashes(_cut(joined, lengths)), _UNIGRAM) & _KEY, pairs])
        levels = [np.frexp(c.astype(float))[1] for c in (own, n)]
        level = np.concatenate(levels)
        data = _pack(lengths, joined, own, filter_of(grams, level))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([data], pa.binary()), pa.array([int(lower_edges(levels[0]).sum())])], ["key", "data", "quantised"])

    for batch in batches:
        for key, kind, data in zip(*(batch.column(c) for c in ("key", "kind", "data"))):
            if key.as_py() != now:
                if now is not None:
                    yield shard()
                now, words, sizes, counts, keys, times, held = key.as_py(), [], [], [], [], [], 0
            got = _unpack(data.as_py())
            if kind.as_py() == _UNIGRAM:
                sizes.append(np.frombuffer(got[0], "<u4"))
                words.append(got[1])
                counts.append(np.frombuffer(got[2], "<i8"))
                continue
            keys.append(_unpack_keys(got[0]))
            times.append(_from_planes(got[1]).astype(np.int64))
            held += len(keys[-1])
            if held >= PENDING_PAIRS and len(keys) > 1:
                key, n = _sum_up(keys, times)
                keys, times, held = [key], [n], 0
    if now is not None:
        yield shard()


def count_words(train: DataFrame) -> DataFrame:
    """Stored (word, n) of all tokens of the texts in ``text``."""
    return cut_lineage(batched(train).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")


def fit(train: DataFrame, words: DataFrame) -> Model:
    """The model of the texts in ``text``, whose counted tokens are ``words``."""
    row = words.agg(F.sum("n").alias("total"), F.count("*").alias("types")).first()
    total, types = row["total"] or 0, row["types"]
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(SHARDS * partitions, -(-total // SHARD_TOKENS))
    kinds = "key long, kind int, data binary"
    sent = batched(train).mapInArrow(_send_pairs(shards), kinds).unionByName(words.mapInArrow(_send_words(shards), kinds))
    built = sent.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(_build, "key long, data binary, quantised long")
    built = cut_lineage(built, "lm-shards")
    quantised = built.agg(F.sum("quantised")).first()[0] or 0
    return Model(total, types, shards, built.select("key", "data"), quantised)


def _ask(shards: int):
    """Rows to (shard, the words and pairs a block asks it for) and (block's name, positions)."""

    def run(batches):
        task = TaskContext.get().partitionId()
        for ordinal, batch in enumerate(slices(batches, limit=BLOCK_BYTES)):
            codes, distinct, sizes = tokens(texts(batch))
            words = distinct.to_pylist()
            first, second, at, _ = _pairs(codes, sizes, words)
            hashes = _hashes(words)
            by_word, word_shard = _dealt(mix(hashes, _UNIGRAM), shards)
            keys = pair_keys(hashes[first], hashes[second])
            by_pair, pair_shard = _dealt(keys, shards)
            word_place, pair_place = np.empty(len(words), np.uint32), np.empty(len(keys), np.uint32)
            word_place[by_word], pair_place[by_pair] = np.arange(len(words)), np.arange(len(keys))
            ordered, keys = [words[i] for i in by_word.tolist()], keys[by_pair] & _KEY
            used = np.union1d(word_shard, pair_shard)
            word_cuts = [np.searchsorted(word_shard, used, side).tolist() for side in ("left", "right")]
            pair_cuts = [np.searchsorted(pair_shard, used, side).tolist() for side in ("left", "right")]
            blobs = [_pack(np.array([len(w) for w in ordered[s:e]], "<u4"), b"".join(ordered[s:e]), _pack_keys(keys[i:j])) for s, e, i, j in zip(*word_cuts, *pair_cuts)]
            own = _pack(_planes(pair_place[at]), _planes(word_place[first[by_pair]]), _planes(word_place[second[by_pair]]))
            # Named by its place and its content: no two blocks share a name, and one rebuilt from other rows does not meet old answers.
            name = xxh64(f"{task} {ordinal} ")
            for blob in [*blobs, own]:
                name.update(blob)
            name = _BLOCK_NAME | name.intdigest() >> 2
            n, ids = len(blobs), batch.column("doc_id")
            lists = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*used.tolist(), name], pa.int64()), pa.array([name] * (n + 1), pa.int64()), pa.array([*blobs, own], pa.binary()), lists, pa.array([None] * n + [sizes], pa.list_(pa.int64()))],
                ["key", "block", "data", "ids", "sizes"],
            )

    return run


def _answer(batches):
    """Rows of shards, the stored shard before what it is asked, to the answers by block; a batch's requests are probed together."""
    now, shard, asked = None, _Shard(None), []

    def answers():
        opened = []
        for block, data in asked:
            sizes, joined, keys = _unpack(data)
            words = _cut(joined, np.frombuffer(sizes, "<u4"))
            opened.append((block, words, _unpack_keys(keys)))
        hashed = mix(_hashes([w for _, words, _ in opened for w in words]), _UNIGRAM)
        levels = shard.levels(np.concatenate([hashed, *[keys for _, _, keys in opened]]))
        word, pair, blobs = 0, len(hashed), []
        for _, words, keys in opened:
            exact = np.array([shard.counts.get(w, 0) for w in words], "<i8")
            blobs.append(_pack(exact, np.concatenate([levels[word : word + len(words)], levels[pair : pair + len(keys)]])))
            word, pair = word + len(words), pair + len(keys)
        return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in opened], pa.int64()), pa.array([now] * len(opened), pa.int64()), pa.array(blobs, pa.binary())], ["key", "shard", "data"])

    for batch in batches:
        for key, block, data in zip(*(batch.column(c) for c in ("key", "block", "data"))):
            key, block = key.as_py(), block.as_py()
            if key >= _BLOCK_NAME:
                continue
            if asked and (key != now or len(asked) == TOGETHER):
                yield answers()
                asked = []
            if key != now:
                now, shard = key, _Shard(data.as_py() if block < 0 else None)
            if block >= 0:
                asked.append((block, data.as_py()))
        if asked:
            yield answers()
            asked = []


def probabilities(pair: np.ndarray, word: np.ndarray, context: np.ndarray, quantised: int) -> np.ndarray:
    """P(b|a) from the levels of the pair and of b and the exact count of a; after any a they add up to 1 at most."""
    alone = np.maximum(lower_edges(word), 1) / (quantised + 1)
    given = np.minimum(lower_edges(pair) / np.maximum(context, 1), 1)
    return np.where(context > 0, BIGRAM_WEIGHT * given + (1 - BIGRAM_WEIGHT) * alone, alone)


def _place(total: int, types: int, quantised: int):
    """The rows of a block with their scores, from its positions and the shards' answers."""

    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        schema = pa.schema(list(zip(names, [blocks.schema.field("ids").type.value_type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))
        out = []
        for row in range(blocks.num_rows if key[0].as_py() >= _BLOCK_NAME else 0):
            by_shard = dict(zip(answers["shard"].to_pylist(), answers["data"].to_pylist()))
            exact, words, pairs = [], [], []
            for s in sorted(by_shard):
                counts, levels = _unpack(by_shard[s])
                exact.append(np.frombuffer(counts, "<i8"))
                words.append(np.frombuffer(levels, np.uint8)[: len(exact[-1])])
                pairs.append(np.frombuffer(levels, np.uint8)[len(exact[-1]) :])
            exact, words, pairs = map(np.concatenate, (exact, words, pairs))
            at, first, second = map(_from_planes, _unpack(blocks["data"][row].as_py()))
            sizes = np.array(blocks["sizes"][row].as_py(), np.int64)
            p = probabilities(pairs, words[second], exact[first], quantised)
            n, owner = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
            second = second[at]
            base = np.bincount(owner, np.log10(exact + 1.0)[second], n) - sizes * math.log10(total + types + 1)
            known = np.bincount(owner, (exact > 0)[second], n).astype(np.int64)
            score = np.bincount(owner, np.log10(p)[at], n)
            out.append(pa.record_batch([blocks["ids"][row].values, pa.array(sizes), pa.array(known), pa.array(np.full(n, total)), pa.array(base), pa.array(score)], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; the model holds the counts of ``words``."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = rows.mapInArrow(_ask(model.shards), f"key long, block long, data binary, ids array<{kind}>, sizes array<long>")
    stored = model.filters.select("key", F.lit(-1).cast("long").alias("block"), "data", F.lit(None).cast(f"array<{kind}>").alias("ids"), F.lit(None).cast("array<long>").alias("sizes"))
    # What is asked goes to its shard and positions to their block's place in one exchange, which both readers use.
    sent = asked.union(stored).repartition(partitions, "key")
    answers = sent.sortWithinPartitions("key", "block").mapInArrow(_answer, "key long, shard long, data binary").repartition(partitions, "key")
    place = _place(model.total, model.types, model.quantised)
    return sent.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(place, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents; folds by crc32 of the key."""
    docs = documents(spark, sf_dir)
    held = fold(F.col("doc_id"), 7) == 2
    train = docs.filter(~held).select("text")
    words = count_words(train)
    found = score(docs, fit(train, words), words)
    return found.select("doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
