"""Periodic runs of words, found with a suffix automaton under link-cut access.

A run is a stretch of words with smallest period q and at least
max(``MIN_WORDS``, ``MIN_EXPONENT`` * q) words that no neighbour extends with
the same period. Of each text the suffix automaton is built; its suffix links
form a tree in which the prefix ending at a word is a node, and the paths to the
root hold all that ends there. Words are then appended one by one: the access to
a prefix's path recolours it with the new end, and the segments it passes,
each of one colour, tell for every earlier end e that is the last occurrence of
something the longest string that ends at e and now. Where the distance p of the
two ends is no more than that length, a square of period p ends here, and it is
primitive, as a shorter period would have put a later end in the way. The
length also says how far the period reaches to the left; the last word with the
same start and period is the run's end on the right.

A word inside a run of exponent four or more occurs four times in it. So a text
is first cut at words with fewer occurrences, its pieces at words with fewer in
the piece, and so on until nothing changes; only the pieces left are searched.
No run is lost, and prose has almost none left.

Defined results: a null text counts as empty and has no runs; repeated rows give
repeated results; of runs with equal length the first is the one with the
smaller start, then period. A text, however long, is one row's work: memory grows
with its longest piece, time with n log n. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import documents, id_text, slices, texts

MIN_WORDS = 6
MIN_EXPONENT = 4


def words_of(text: str) -> list[bytes]:
    """bytes.split() parts at exactly the six ASCII spaces."""
    return text.encode("utf-8", "surrogatepass").split()


def pieces(codes: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches that can hold runs; words of a text are neighbours with equal ``rows``."""
    at = np.arange(len(codes))
    piece, kept = rows, np.ones(len(codes), bool)
    while len(at):
        # Number the (piece, word) pairs and count them.
        _, small = np.unique(codes[at], return_inverse=True)
        _, pair, times = np.unique(piece.astype(np.int64) * (int(small.max()) + 1) + small, return_inverse=True, return_counts=True)
        often = times[pair] >= MIN_EXPONENT
        new = np.cumsum(np.concatenate([[True], (np.diff(at[often]) > 1) | (np.diff(piece[often]) != 0)])) if often.any() else np.zeros(0, np.int64)
        long = np.bincount(new)[new] >= MIN_WORDS if len(new) else np.zeros(0, bool)
        done = often.all() and long.all()
        at, piece = at[often][long], new[long]
        if done:
            break
    if not len(at):
        return []
    edges = np.flatnonzero(np.diff(piece)) + 1
    return list(zip(at[np.concatenate([[0], edges])].tolist(), (at[np.concatenate([edges - 1, [len(at) - 1]])] + 1).tolist()))


def link_tree(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link and longest string of every state, the state of every prefix) of the suffix automaton."""
    link, longest, step, ends, last = [-1], [0], [{}], [], 0
    for c in word:
        now = len(link)
        longest.append(longest[last] + 1)
        step.append({})
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[p] + 1 == longest[q]:
                link[now] = q
            else:
                clone = len(link)
                longest.append(longest[p] + 1)
                step.append(step[q].copy())
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        ends.append(now)
        last = now
    return link, longest, ends


class Paths:
    """The link tree cut into paths of one colour, each a splay tree in order of depth.

    ``up`` of a path's top splay node is the path's parent in the tree, which
    does not know it as a child; ``colour`` counts at the top splay node.
    """

    def __init__(self, link: list[int], longest: list[int]):
        n = len(link)
        self.up, self.left, self.right, self.colour, self.longest = list(link), [-1] * n, [-1] * n, [-1] * n, longest

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            child = left[y] = right[x]
            right[x] = y
        else:
            child = right[y] = left[x]
            left[x] = y
        if child >= 0:
            up[child] = y
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        up[x], up[y] = z, x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        if up[x] < 0 or (left[up[x]] != x and right[up[x]] != x):
            return
        top = up[x]
        while up[top] >= 0 and (left[up[top]] == top or right[up[top]] == top):
            top = up[top]
        colour = self.colour[top]
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                break
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)
        self.colour[x] = colour

    def access(self, node: int, end: int) -> list[tuple[int, int]]:
        """(colour, longest string) of the segments from ``node`` up to the root, which then are one path of colour ``end``."""
        passed, below, x = [], -1, node
        while x >= 0:
            self._splay(x)
            if self.colour[x] >= 0:
                passed.append((self.colour[x], self.longest[x]))
            if self.right[x] >= 0:
                # What lies deeper is a path of its own now, in its old colour.
                self.colour[self.right[x]] = self.colour[x]
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = end
        self._splay(node)
        self.colour[node] = end
        return passed


def squares(word: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) of each maximal repetition of exponent two or more -> its last word."""
    link, longest, ends = link_tree(word)
    paths, found = Paths(link, longest), {}
    for i, state in enumerate(ends):
        for end, length in paths.access(state, i):
            p = i - end
            if 0 < p <= length:
                found[i - length - p + 1, p] = i
    return found


def runs(word: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period."""
    found = ((s, e - s + 1, p) for (s, p), e in squares(word).items())
    return sorted(((s, n, p) for s, n, p in found if n >= max(MIN_WORDS, MIN_EXPONENT * p)), key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text's words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(texts)), sizes)
    flat = pa.array([w for t in texts for w in t], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy() if len(flat) else np.zeros(0, np.int32)
    out: list[list] = [[] for _ in texts]
    known: dict[bytes, list] = {}  # copies in a slice are searched once
    for s, e in pieces(codes, rows):
        part = codes[s:e]
        found = known.get(name := part.tobytes())
        if found is None:
            found = known[name] = runs(part.tolist())
        row = int(rows[s])
        shift = s - int(starts[row])
        out[row] += [(shift + at, n, p) for at, n, p in found]
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without what repeats a run's first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def tail_repeated(words: list[bytes], key: int | None) -> list[bytes]:
    """The words as the contract of the query alters them: some texts, by their key, end in a repeated passage.

    A text with a null key stays as it is.
    """
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_FIELDS = [
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare=None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: the runs as structs and the text that is left without repeats.

    ``prepare(words, doc_id)`` may replace the words first.
    """
    return _mapped(docs, id_col, text_col, prepare, "runs array<struct<start: long, length: long, period: long>>, collapsed string", _spelled)


def summaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare=None) -> DataFrame:
    """(doc_id, n_runs, the longest run's start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row."""
    kinds = {pa.int64(): "long", pa.string(): "string"}
    return _mapped(docs, id_col, text_col, prepare, ", ".join(f"{n} {kinds[t]}" for n, t in _FIELDS), _summed)


def _mapped(docs, id_col, text_col, prepare, fields: str, shape) -> DataFrame:
    rows = id_text(docs, id_col, text_col)

    def run(batches):
        for batch in slices(batches):
            words, ids = [words_of(t) for t in texts(batch)], batch.column("doc_id")
            if prepare is not None:
                words = [prepare(w, key) for w, key in zip(words, ids.to_pylist())]
            columns = shape(words, runs_of(words))
            yield pa.RecordBatch.from_arrays([ids, *columns.values()], ["doc_id", *columns])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}")


def _spelled(words, found):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    listed = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
    return {"runs": pa.array(listed, kind), "collapsed": pa.array([collapsed(w, f).decode("utf-8", "surrogatepass") for w, f in zip(words, found)], pa.string())}


def _summed(words, found):
    rows = []
    for w, f in zip(words, found):
        best = min(f, key=lambda r: (-r[1], r[0], r[2])) if f else (None,) * 3
        exponent = 1000 * best[1] // best[2] if f else None
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in f).encode()
        rows.append((len(f), *best, exponent, _digest(listed), _digest(collapsed(w, f))))
    return {name: pa.array(c, t) for (name, t), c in zip(_FIELDS, zip(*rows))}


def query(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, some of whose texts end in a repeated passage."""
    return summaries(documents(spark, sf_dir), prepare=tail_repeated)
