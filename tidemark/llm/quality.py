"""Quality rules with thresholds that adapt to each language and source.

Features of every text are counted once. Per language and source, mergeable
quantile sketches (KLL) of the features are aggregated over the texts that pass
the base rules: every task sends one sketch per group, however many rows a group
has. A group of fewer than ``MIN_GROUP`` such rows uses the sketch of its
language, merged from the groups' sketches, and a small language the merged
sketch of all. A feature is out of bounds beyond its ``UPPER`` quantile plus
``FENCE`` times that quantile's distance from the median; the mean word length
also as far below. The thresholds are joined to the rows and filter them.

Most texts have no symbols and no repeats, so the quantiles of the plain rates
are zero. The ``UPPER`` quantile of a rate is therefore that of the rates with
one event more than was found (``EVENTS``), which fall with a text's length and
are never zero; the median and the judged rate are those of what was found.

Defined results: a null or empty text has no words and fails the base rules;
a very long text is a slice of its own and is counted whole; null languages and
sources are groups of their own; a value equal to its bound is within it, so
equal values (ties) share a verdict, and a group of equal values keeps them all;
repeated rows count each and give repeated results; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import batched, documents, slices, texts
from tidemark.operators.blocks import attach_stats
from tidemark.session import cut_lineage

MIN_WORDS = 50
MIN_GROUP = 200
SKETCH_K = 4000  # rank error about 0.1 %
UPPER = 0.9
FENCE = 3.0
# What one event adds to a count: a symbol, a repeated line, the words of two equal three-word windows.
EVENTS = {"symbol_rate": ("n_symbols", 1), "dup_line_rate": ("n_dup_lines", 1), "repeat_rate": ("n_repeat_words", 6)}
FEATURES = (*EVENTS, "word_length")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def repeated_words(codes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the words inside three-word windows that the row holds twice or more; ``codes`` number the words."""
    n = len(codes)
    if n < 3:
        return np.zeros(rows, np.int64)
    inside = (row[2:] == row[:-2]).nonzero()[0]
    size = np.uint64(int(codes.max()) + 1)
    pairs = codes[inside].astype(np.uint64) * size + codes[inside + 1].astype(np.uint64)
    # Pairs are numbered before the third word joins, so that no key overflows.
    _, pairs = np.unique(pairs, return_inverse=True)
    triples = pairs.astype(np.uint64) * size + codes[inside + 2].astype(np.uint64)
    _, triples = np.unique(triples, return_inverse=True)
    order = np.lexsort((row[inside], triples))
    t, r = triples[order], row[inside][order]
    same = (t[1:] == t[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(n, bool)
    at = inside[order[twice]]
    for step in range(3):
        covered[at + step] = True
    return np.bincount(row[covered], minlength=rows)


def count(rows: list[str]) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in rows]  # bytes.split() parts at exactly the six ASCII spaces
    sizes = np.fromiter(map(len, words), np.int64, len(rows))
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy() if len(flat) else np.zeros(0, np.int32)
    lines, dups = [], []
    for t in rows:
        own = [x for x in t.split("\n") if x.strip(_SPACES)]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    return {
        "n_words": sizes,
        "word_chars": np.array([len(t) - sum(map(t.count, _SPACES)) for t in rows], np.int64),
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in rows], np.int64),
        "n_lines": np.array(lines, np.int64),
        "n_dup_lines": np.array(dups, np.int64),
        "n_repeat_words": repeated_words(codes, np.repeat(np.arange(len(rows)), sizes), len(rows)),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(doc_id, g0, g1, ..., counts) of every row."""
    groups = [f"g{i}" for i in range(len(by))]
    rows = batched(docs).select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"`{c}`").cast("string").alias(g) for c, g in zip(by, groups)], F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches):
            got = count(texts(batch))
            names = ["doc_id", *groups]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *[pa.array(got[c], pa.int64()) for c in COUNTS]], [*names, *COUNTS])

    kinds = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}", *[f"{g} string" for g in groups], *[f"{c} long" for c in COUNTS]]
    return rows.mapInArrow(run, ", ".join(kinds))


def features() -> dict[str, Column]:
    """The judged values per word: rates of what was found, and the mean length."""
    words = F.col("n_words").cast("double")
    rates = {name: F.col(c) / words for name, (c, _) in EVENTS.items()}
    return {**rates, "word_length": F.col("word_chars") / words}


def with_event() -> dict[str, Column]:
    """The rates with one event more than was found."""
    return {f"more_{name}": (F.col(c) + F.lit(event)) / (F.col("n_words") + F.lit(event)) for name, (c, event) in EVENTS.items()}


def _key(columns: list[str]) -> Column:
    """The values of a group as one text that keeps nulls apart."""
    return F.to_json(F.array(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}) if columns else F.lit("all")


def thresholds(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Per ``_key`` of a group, ``low_*`` and ``high_*`` of every feature.

    The groups' sketches are merged for each leading part of the group columns
    (language and source, language, all); bounds come from the narrowest part
    with ``MIN_GROUP`` rows. Only the bounds of all rows reach the driver.
    """
    names = [*FEATURES, *with_event()]
    sketched = measured.filter("n_words > 0").withColumns({**features(), **with_event()}).groupBy(*groups).agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(f, F.lit(SKETCH_K)).alias(f"s_{f}") for f in names]
    )
    sketched = cut_lineage(sketched, "quality-sketches")
    parts = F.array(*[_key(groups[:depth]) for depth in range(len(groups) + 1)])
    merged = sketched.select(F.posexplode(parts).alias("depth", "part"), "n", *[f"s_{f}" for f in names])
    merged = merged.groupBy("depth", "part").agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"s_{f}").alias(f"s_{f}") for f in names])
    bounds = []
    for f in FEATURES:
        low, middle = (F.kll_sketch_get_quantile_double(f"s_{f}", F.lit(r)) for r in (1 - UPPER, 0.5))
        high = F.kll_sketch_get_quantile_double(f"s_more_{f}" if f in EVENTS else f"s_{f}", F.lit(UPPER))
        bounds += [(low - (middle - low) * FENCE).alias(f"low_{f}"), (high + (high - middle) * FENCE).alias(f"high_{f}")]
    limits = [f"{side}_{f}" for f in FEATURES for side in ("low", "high")]
    bounded = cut_lineage(merged.select("depth", "part", "n", *bounds), "quality-bounds")
    every = bounded.filter("depth = 0").first()
    out = sketched.select(*[parts[d].alias(f"_p{d}") for d in range(len(groups) + 1)], *[F.lit(every[c] if every else None).cast("double").alias(c) for c in limits])
    for depth in range(1, len(groups) + 1):
        own = bounded.filter((F.col("depth") == depth) & (F.col("n") >= MIN_GROUP))
        own = own.select(F.col("part").alias(f"_p{depth}"), *[F.col(c).alias(f"own_{c}") for c in limits])
        out = out.join(own, f"_p{depth}", "left").withColumns({c: F.coalesce(f"own_{c}", c) for c in limits}).drop(*[f"own_{c}" for c in limits])
    return out.select(F.col(f"_p{len(groups)}").alias("_key"), *limits)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every row."""
    groups = [f"g{i}" for i in range(len(by))]
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = cut_lineage(measure(docs, id_col, text_col, by).withColumn("base_failed", base_failed), "quality-counts")
    passing = judged.filter(~F.col("base_failed"))
    keyed = passing.withColumn("_key", _key(groups)).withColumns(features())
    rows = attach_stats(keyed, thresholds(passing, groups), ["_key"], ["doc_id", "n_words", "word_chars"])
    fits = F.col("word_length") >= F.col("low_word_length")
    for f in FEATURES:
        fits = fits & (F.col(f) <= F.col(f"high_{f}"))
    columns = ["doc_id", *COUNTS, "base_failed", "kept"]
    failed = judged.filter("base_failed").withColumn("kept", F.lit(False))
    return rows.withColumn("kept", fits).select(*columns).unionByName(failed.select(*columns))


def query(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of all documents."""
    return judge(documents(spark, sf_dir))
