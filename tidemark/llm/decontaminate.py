"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and white space runs become one space. An item
of m characters may match with up to k = floor(RATE * m) edits. It is split
into k + 1 pieces, of which k edits leave one whole, so an Aho-Corasick pass
over a text finds every candidate. Pieces form groups of up to four: where all
groups of c pieces had c edits or more, there would be more than k, so some
group matches with c - 1 edits and holds a whole piece. A hit is therefore
first verified on its group, then on the whole item, both with Myers'
bit-parallel distance (integers of any length hold the bit vectors).

The items are a stated query set. They are dealt into blocks of bounded size,
each broadcast and matched against all rows; the rows are not shuffled.

Items below ``MIN_CHARS`` normalised characters are one piece each: they are
searched in the same automaton, exactly, and count where neither end cuts a
word (letters of scripts that write no spaces may stand on either side).

Defined results: a null or empty text or item matches nothing; repeated
items with one key report once per text, with the least distance; repeated
rows give repeated results; of equal distances the first place is reported.
An empty table of texts or items gives no rows. Texts of any length are
searched whole. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import documents, id_text, once, positional, slices, texts

RATE = 0.1
MIN_CHARS = 20
GROUP = 4
# Characters of items that one broadcast block holds.
BLOCK_CHARS = 1 << 20


def normalize(text: str) -> str:
    return " ".join(text.lower().split())


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return dict(out)


def search(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least distance, first end) of the pattern against any substring of ``text`` (Myers 1999)."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(text):
        eq = peq.get(c, 0)
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
            if score < best:
                best, end = score, at + 1
        ph, xv = (ph << 1) & full, eq | mv
        pv, mv = ((mh << 1) & full) | (full & ~(xv | ph)), ph & xv
    return best, end


def cuts_word(text: str, at: int) -> bool:
    """Whether a word goes on across position ``at``; scripts of letters without case may stand without spaces."""
    return 0 < at < len(text) and all(c.isalnum() and unicodedata.category(c) != "Lo" for c in text[at - 1 : at + 1])


class Matcher:
    """The automaton and bit masks of a block of (key, text) items; built once per worker."""

    def __init__(self, items: list[tuple], rate: float):
        self.items, pieces = [], defaultdict(list)
        for key, raw in items:
            text = normalize(raw or "")
            if not text:
                continue
            number = len(self.items)
            if len(text) < MIN_CHARS:
                self.items.append((key, len(text), 0, None))
                pieces[text].append((number, 0, len(text), None))
                continue
            k = int(len(text) * rate)
            cuts = [i * len(text) // (k + 1) for i in range(k + 2)]
            self.items.append((key, len(text), k, masks(text)))
            for first in range(0, k + 1, GROUP):
                ends = cuts[first : first + GROUP + 1]
                group = (ends[0], ends[-1], len(ends) - 2, masks(text[ends[0] : ends[-1]]))
                for start, end in zip(ends, ends[1:]):
                    pieces[text[start:end]].append((number, start, end - start, group))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, owners)
        if pieces:
            self.automaton.make_automaton()

    def find(self, raw: str) -> dict:
        """{key: (distance, start of the verified window, end)} of the items in a text, in normalised characters."""
        text = normalize(raw)
        found = {}
        if not text or not self.items:
            return found
        tried = set()
        for last, owners in self.automaton.iter(text):
            for number, offset, size, group in owners:
                if group is None:
                    key, first = self.items[number][0], last + 1 - size
                    if found.get(key, (1,))[0] and not cuts_word(text, first) and not cuts_word(text, last + 1):
                        found[key] = (0, first, last + 1)
                    continue
                start, end, budget, peq = group
                diagonal = last + 1 - size - offset
                if (number, start, diagonal) in tried:
                    continue
                tried.add((number, start, diagonal))
                key, m, k, item = self.items[number]
                if found.get(key, (1,))[0] == 0:
                    continue
                if budget and search(peq, end - start, text[max(0, diagonal + start - budget) : diagonal + end + budget])[0] > budget:
                    continue
                left = max(0, diagonal - k)
                distance, stop = search(item, m, text[left : diagonal + m + k])
                if distance <= k and (key not in found or distance < found[key][0]):
                    found[key] = (distance, left, left + stop)
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """(name, broadcast) blocks of the items: the number of blocks grows with the items, not the size of one."""
    items = id_text(benchmark, id_col, text_col).filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = total // BLOCK_CHARS + 1
    spark = benchmark.sparkSession
    for block in range(count):
        own = items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == block)
        yield uuid4().hex, spark.sparkContext.broadcast([tuple(r) for r in own.collect()])


def _matcher(name: str, shared, rate: float) -> Matcher:
    return once("matcher", name, lambda: Matcher(shared.value, rate))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, end): one row for each text and item found in it."""
    rows = id_text(docs, id_col, text_col)
    kind = benchmark.schema[item_id].dataType
    key_type = to_arrow_type(kind)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {kind.simpleString()}, distance int, start long, end long"
    out = None
    for name, shared in _blocks(benchmark, item_id, item_text):

        def run(batches, name=name, shared=shared):
            matcher = _matcher(name, shared, rate)
            for batch in slices(batches):
                at, got = [], []
                for i, text in enumerate(texts(batch)):
                    for key, (distance, start, end) in matcher.find(text).items():
                        at.append(i)
                        got.append((key, distance, start, end))
                columns = list(zip(*got)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(columns[0], key_type), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[2:]]],
                    ["doc_id", "item_id", "distance", "start", "end"],
                )

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows whose text holds no item; nothing is shuffled."""
    out = positional(docs)
    column = out.columns[docs.columns.index(text_col)]
    for name, shared in _blocks(benchmark, item_id, item_text):

        def run(batches, name=name, shared=shared):
            matcher = _matcher(name, shared, rate)
            for batch in slices(batches, column):
                yield batch.filter(pa.array([not matcher.find(t) for t in texts(batch, column)], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "item_id", "distance")
