"""Language identification by bit-sliced Bloom filters of character trigrams.

Training counts the trigrams of letters (word edges as spaces) per language
over all training rows and keeps every one. A trigram has a depth in a language:
1 if it occurs at all, and one more for each of ``LEVELS`` - 1 rates (powers of
``BASE``) that it reaches there. One filter holds all languages: every slot is a
bitmask with one bit per language, and the AND of the slots of (trigram, level)
is the mask of the languages that contain the trigram to that depth.

A text's bits are counted per language over all levels, corrected for the
language's rate of false positives, and divided by the mean depth of the
language's own trigrams: 1 is a text like the language's own. The largest
quotient decides, cut to 0..1 it is the score. The filter has some ``SPARE``
slots a member, ``MAX_SLOTS`` (32 MB for 64 languages) at most: beyond that
nothing is left out, but more probes are false and more is corrected.

Defined results: ``und`` with score 0 for a null text, a text without letters
and where nothing could be learned; ties go to the language first by name. A
very long text is a slice of its own and counts whole; repeated rows count each
in training and have equal results; an empty table gives no rows. Language,
source and key are no inputs of a prediction. Other columns of the input are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import batched, documents, fold, mix, positional, slices, texts
from tidemark.session import cut_lineage

HASHES = 4
LEVELS, BASE = 8, 4
SPARE = 8
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 22
UNKNOWN = "und"
# Text of a slice, whose arrays take some fifty times its size, and counts a task adds up at a time.
SLICE = 1 << 18
HELD_GRAMS = 1 << 20
# Below this score no learned language explains the text (the pipeline rejects it).
MIN_SCORE = 0.3

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def trigrams(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every trigram of the rows' letters: three code points of 21 bits each.

    Runs of other characters count as one space, also before and after the text; rows end at a line feed.
    """
    points = np.frombuffer("\n".join(f" {t} " for t in rows).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    joints = np.zeros(len(points), bool)
    joints[np.cumsum([len(t.lower()) + 3 for t in rows[:-1]], dtype=np.int64) - 1] = True
    points = np.where(_letters()[points], points, np.uint32(32))
    points[joints] = 10
    row = np.cumsum(joints)
    keep = np.ones(len(points), bool)
    keep[1:] = ~((points[1:] == 32) & (points[:-1] == 32))
    points, row = points[keep].astype(np.uint64), row[keep]
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    whole = (a != 10) & (b != 10) & (c != 10) & (b != 32)
    # A space in the middle would span two words; a lone space pair cannot occur.
    keys = (a << np.uint64(42)) | (b << np.uint64(21)) | c
    return keys[whole], row[1:-1][whole]


def slots_of(keys: np.ndarray, level: int, slots: int) -> list[np.ndarray]:
    """The slots of (trigram, level); ``slots`` is a power of two."""
    return [mix(keys, level * HASHES + salt) & np.uint64(slots - 1) for salt in range(HASHES)]


def depth_of(rate: Column) -> Column:
    """1 for any rate, one more for each power of ``BASE`` from the ``LEVELS`` - 1st inverse one upwards that it reaches."""
    reached = [(rate >= float(BASE) ** (level - LEVELS - 1)).cast("int") for level in range(2, LEVELS + 1)]
    return sum(reached, F.lit(1))


@dataclass
class Model:
    languages: list[str]
    masks: np.ndarray  # (planes of 64 languages, slots)
    false_rate: np.ndarray  # per language
    depth: np.ndarray  # mean depth of a language's own trigrams


def _count(batches):
    """(lang, gram, n) of a task's rows; what its slices count is added up before it goes out."""
    found, held = {}, 0

    def sums():
        for lang, parts in found.items():
            merged = pa.table([pa.concat_arrays([p.field(i) for p in parts]) for i in (0, 1)], ["gram", "n"]).group_by("gram").aggregate([("n", "sum")])
            yield lang, merged["gram"].combine_chunks(), merged["n_sum"].combine_chunks()

    def rows():
        for lang, grams, n in sums():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), grams, n], ["lang", "gram", "n"])

    for batch in slices(batches, limit=SLICE):
        langs = np.array(batch.column("lang").to_pylist())
        own = texts(batch)
        for lang in np.unique(langs):
            keys, _ = trigrams([own[i] for i in np.flatnonzero(langs == lang)])
            counts = pc.value_counts(pa.array(keys.view(np.int64)))
            found.setdefault(str(lang), []).append(counts)
            held += len(counts)
        if held > HELD_GRAMS:
            yield from rows()
            found, held = {}, 0
    yield from rows()


def _slot_rows(slots: int):
    def run(batches):
        for batch in batches:
            keys, bit, depth = (batch.column(c).to_numpy() for c in ("gram", "bit", "depth"))
            for level in range(1, LEVELS + 1):
                own = depth >= level
                found = slots_of(keys[own].view(np.uint64), level, slots)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)), pa.array(np.tile(bit[own], HASHES))], ["slot", "bit"])

    return run


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the rows that have a language; all of them count, without sampling."""
    rows = batched(docs).select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    counted = rows.filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(_count, "lang string, gram long, n long")
    counts = cut_lineage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    languages = sorted(totals)
    slots, depth = MIN_SLOTS, np.ones(len(languages))
    planes = max((len(languages) + 63) // 64, 1)
    masks = np.zeros((planes, slots), np.uint64)
    if languages:
        number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
        total = F.create_map(*[F.lit(x) for lang in languages for x in (lang, totals[lang])])
        members = counts.select("gram", "n", number[F.col("lang")].cast("int").alias("bit"), depth_of(F.col("n") / total[F.col("lang")]).alias("depth"))
        sizes = members.groupBy("bit").agg((F.sum(F.col("n") * F.col("depth")) / F.sum("n")).alias("mean"), F.sum("depth").alias("members")).collect()
        for r in sizes:
            depth[r["bit"]] = r["mean"]
        slots = min(max(MIN_SLOTS, 1 << (SPARE * sum(r["members"] for r in sizes) - 1).bit_length()), MAX_SLOTS)
        masks = np.zeros((planes, slots), np.uint64)
        found = members.select("gram", "bit", "depth").mapInArrow(_slot_rows(slots), "slot long, bit int").distinct()
        # At most one row per slot and 64 languages reaches the driver.
        plane = (F.col("bit") / 64).cast("int").alias("plane")
        mask = F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask")
        got = found.groupBy("slot", plane).agg(mask).toArrow()
        masks[got["plane"].to_numpy(), got["slot"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    fill = [float(np.mean((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(languages))]
    return Model(languages, masks, np.array(fill) ** HASHES, depth)


def depths(model: Model, keys: np.ndarray) -> np.ndarray:
    """(trigrams, languages): at how many levels the filter says that a language contains the trigram."""
    out = np.zeros((len(keys), len(model.languages)))
    for level in range(1, LEVELS + 1):
        slots = slots_of(keys, level, model.masks.shape[1])
        for plane, masks in enumerate(model.masks):
            inside = masks[slots[0]]
            for more in slots[1:]:
                inside = inside & masks[more]
            for i in range(plane * 64, min(plane * 64 + 64, len(model.languages))):
                out[:, i] += (inside >> np.uint64(i % 64)) & np.uint64(1)
    return out


def _classify(model: Model, rows: list[str]) -> tuple[list[str], np.ndarray]:
    keys, row = trigrams(rows)
    n = np.bincount(row, minlength=len(rows)).astype(float)
    likeness = np.zeros((len(rows), max(len(model.languages), 1)))
    # A trigram that many rows of the slice hold is probed once.
    distinct, at = np.unique(keys, return_inverse=True)
    found = depths(model, distinct)
    for i, (false, depth) in enumerate(zip(model.false_rate, model.depth)):
        mean = np.bincount(row, found[at, i], len(rows)) / np.maximum(n, 1)
        likeness[:, i] = (mean - LEVELS * false) / max(1 - false, 1e-9) / depth
    best = likeness.argmax(axis=1)
    score = np.clip(likeness[np.arange(len(rows)), best], 0, 1)
    known = (n > 0) & bool(model.languages)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` added (a column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score")
    plain = positional(kept)
    column = plain.columns[kept.columns.index(text_col)]

    def run(batches):
        for batch in slices(batches, column, SLICE):
            lang, score = _classify(shared.value, texts(batch, column))
            arrays = [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*plain.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*kept.columns, "lang_pred", "score")


def known_language(docs: DataFrame, folds: int = 4, held_out: int = 2, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text a language learned from the other folds explains, with their own columns."""
    model = train(docs.filter(fold(F.col("doc_id"), folds) != held_out))
    added = docs.select(F.col("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = predict(added, model, "_text").filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; folds by crc32 of the key."""
    docs = documents(spark, sf_dir)
    held = fold(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
