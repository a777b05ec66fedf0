"""URL rules by Bloom filter cascades: exact membership without joins.

A url's candidate keys are its host and parent hosts, each with the path
prefixes whose lengths occur in the lists. The distinct candidate keys of the
whole corpus are the complete universe of questions a list is asked. A
cascade for a list encodes at level 1 the listed keys, at level 2 the other
universe keys that level 1 lets pass (the universe is probed where it lies; only
what passes is joined with the list), at level 3 the listed keys that level 2
lets pass, and so on until nothing passes falsely. A key is listed if the
first level that does not hold it is an even one, or none and the last is odd.
So every question of this corpus has its exact answer, from a few bits per
listed key, and the urls are neither shuffled nor joined.

The size of a cascade follows the list, not the corpus. A list is dealt into
shards of at most ``SHARD_KEYS`` keys, each with a cascade of its own, so one
filter has a proven bound whatever the list's size; the shards of all lists
answer one after the other.

Rules (host, path) fit a host and its subdomains and paths that start with the
rule's; the longest fitting rule (by characters of host and path) decides, and
of an allow and a block rule of one key the block. Without a rule, urls under
a listed host are blocked and others allowed.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is allowed; very long urls are judged whole; repeated rows give
repeated results; empty lists fit nothing, an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import filter_bits, has_bit, mix
from tidemark.session import cut_lineage, ensure_session

SHARD_KEYS = 1 << 24
LOCAL_KEYS = 1 << 18  # 4 MB of hashes
MAX_LEVELS = 200  # keys halve at each: beyond this two of them cannot be told apart
NEXT_BITS = 2  # per key of a level after the first
# The rules of the query, and the words that mark hosts to be blocked.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam", "track")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parent_hosts(host: Column, labels: int) -> Column:
    """The host and its parents of at most ``labels`` labels, longest first; none for an empty host."""
    parts = F.split(host, r"\.")
    first = F.greatest(F.size(parts) - labels + 1, F.lit(1))
    return F.when(host != "", F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))).otherwise(F.array().cast("array<string>"))


def candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Keys (host and path prefix) a listed key can equal, longest first, then longest host first."""
    sizes = F.array(*[F.lit(n) for n in lengths])
    prefixes = F.transform(F.filter(sizes, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    keys = F.flatten(F.transform(parent_hosts(host, labels), lambda h: F.transform(prefixes, lambda p: F.struct((-F.length(h) - F.length(p)).alias("size"), (-F.length(h)).alias("host"), F.concat(h, p).alias("key")))))
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, number: int, bits: int) -> list[np.ndarray]:
    own = mix(h1 ^ mix(h2, level), level)
    return [mix(own, 1000 + i) % np.uint64(bits) for i in range(number)]


class Cascade:
    """Levels of (bits, hashes, table) that answer exactly for the universe they were built over."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
        listed = np.full(len(h1), len(self.levels) % 2 == 1)
        open_ = np.arange(len(h1))
        for level, (bits, number, table) in enumerate(self.levels):
            inside = np.ones(len(open_), bool)
            for at in _positions(h1[open_], h2[open_], level, number, bits):
                inside &= has_bit(table, at)
            listed[open_[~inside]] = level % 2 == 1
            open_ = open_[inside]
        return listed


def _level_rows(level: int, number: int, bits: int):
    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_positions(h1, h2, level, number, bits)).astype(np.int64))], ["at"])

    return run


def _passing(rows: DataFrame, level: int, number: int, bits: int, table: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            inside = np.ones(batch.num_rows, bool)
            for at in _positions(h1, h2, level, number, bits):
                inside &= has_bit(shared.value, at)
            yield batch.filter(pa.array(inside))

    return rows.mapInArrow(run, "h1 long, h2 long")


def _level(listed: int, others: int, level: int) -> tuple[int, int]:
    """(bits, hashes) of a level: the first lets about as many others pass as there are listed keys, each later one half."""
    per_key = NEXT_BITS if level else max(NEXT_BITS, 1.44 * math.log2(max(2, others / listed)))
    return max(64, math.ceil(listed * per_key)), max(1, round(per_key * 0.7))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade of the hashed keys ``listed`` (h1, h2) that answers exactly for ``universe``, which may hold listed keys.

    The first level is built from the list alone and the universe is probed with
    it where it lies. Only what passes, about twice the list, is told from the
    listed keys by a join. Each later level is a Spark job over what the last
    one let pass falsely; only bit tables, bounded by the list, reach the
    driver. Once ``LOCAL_KEYS`` keys are left in all, it finishes the same
    levels by itself.
    """
    levels: list[tuple[int, int, np.ndarray]] = []
    inside, outside = listed, universe
    n, m = inside.count(), outside.count()
    while n and (not levels or n + m > LOCAL_KEYS):
        bits, number = _level(n, m, len(levels))
        table = filter_bits(inside.mapInArrow(_level_rows(len(levels), number, bits), "at long"), "at", bits)
        passing = _passing(outside, len(levels), number, bits, table)
        if not levels:
            passing = passing.join(inside, ["h1", "h2"], "left_anti")
        inside, outside = cut_lineage(passing, "cascade-level"), inside
        levels.append((bits, number, table))
        n, m = inside.count(), n
    if not n:
        return Cascade(levels)
    near, far = (tuple(t[c].to_numpy().view(np.uint64) for c in ("h1", "h2")) for t in (inside.toArrow(), outside.toArrow()))
    while len(near[0]):
        if len(levels) > MAX_LEVELS:
            raise ValueError("two keys with the same 128-bit hash")
        bits, number = _level(len(near[0]), len(far[0]), len(levels))
        table = np.zeros(bits, np.uint8)
        for at in _positions(*near, len(levels), number, bits):
            table[at] = 1
        table = np.packbits(table, bitorder="little")
        passing = np.ones(len(far[0]), bool)
        for at in _positions(*far, len(levels), number, bits):
            passing &= has_bit(table, at)
        levels.append((bits, number, table))
        near, far = tuple(h[passing] for h in far), near
    return Cascade(levels)


def _shard(column: str, shards: int) -> Column:
    return F.pmod(F.col(column), F.lit(shards))


def build_list(keys: DataFrame, universe: DataFrame) -> tuple[int, list[Cascade]]:
    """(shards, a cascade per shard) of a list's hashed keys against the hashed universe."""
    keys = cut_lineage(keys.select("h1", "h2").distinct(), "listed-keys")
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
    universe = universe.select("h1", "h2")
    return shards, [build(keys.filter(_shard("h1", shards) == s), universe.filter(_shard("h1", shards) == s)) for s in range(shards)]


def judge(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    ``rules`` has verdict, host and path, ``blocked_hosts`` host; hosts in lower case.
    """
    rules = cut_lineage(rules.select("verdict", "host", "path").filter("host != ''").distinct(), "url-rules")
    blocked_hosts = cut_lineage(blocked_hosts.select("host").filter("host != ''").distinct(), "url-hosts")
    # What candidate keys need to know of the lists: path lengths and the most labels of a host.
    sizes = F.size(F.split("host", r"\."))
    needs = rules.select(F.length("path").alias("length"), sizes.alias("labels")).unionByName(blocked_hosts.select(F.lit(0).alias("length"), sizes.alias("labels")))
    needs = needs.groupBy("length").agg(F.max("labels").alias("labels")).collect()
    lengths, labels = sorted({0, *(r["length"] for r in needs)}), max([1, *(r["labels"] for r in needs)])
    url = F.col(f"`{url_col}`").cast("string")
    asked = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    asked = asked.withColumn("keys", candidates(F.col("host"), F.col("path"), labels, lengths))
    universe = cut_lineage(hashed(asked.select(F.explode("keys").alias("key")).distinct()), "url-universe")
    rule_keys = hashed(rules.select(F.concat("host", "path").alias("key"), "verdict").groupBy("key").agg(F.max("verdict").alias("verdict")))
    blocking = hashed(rules.filter("verdict = 'block'").select(F.concat("host", "path").alias("key")).distinct())
    spark = pages.sparkSession
    lists = [build_list(k, universe) for k in (rule_keys, blocking, hashed(blocked_hosts.select(F.col("host").alias("key"))))]
    shared = spark.sparkContext.broadcast(lists)

    def run(batches):
        for batch in batches:
            keys = batch.column("h1")
            h1, h2 = keys.flatten().to_numpy(), batch.column("h2").flatten().to_numpy()
            offsets = keys.offsets.to_numpy() - keys.offsets[0].as_py()
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            ruled, blocks, hosts = (_holds(found, h1, h2) for found in shared.value)
            # Keys come longest first: the first that is a rule decides.
            first = np.full(batch.num_rows, -1)
            at = np.flatnonzero(ruled)[::-1]
            first[row[at]] = at
            decided = first >= 0
            listed = np.bincount(row[hosts], minlength=batch.num_rows) > 0
            block = np.where(decided, blocks[first] if len(h1) else False, listed)
            place = pa.array(np.where(decided, first - offsets[:-1] + 1, 0), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), batch.column("keys"), place, pa.array(np.where(block, "block", "allow"), pa.string())], ["page_id", "host", "path", "keys", "place", "verdict"])

    hashes = asked.select("*", F.transform("keys", lambda k: F.xxhash64(k)).alias("h1"), F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))).alias("h2"))
    kind = asked.schema["page_id"].dataType.simpleString()
    judged = hashes.mapInArrow(run, f"page_id {kind}, host string, path string, keys array<string>, place int, verdict string")
    return judged.select("page_id", "host", "path", F.when(F.col("place") > 0, F.try_element_at("keys", F.col("place"))).alias("rule"), "verdict")


def _holds(found: tuple[int, list[Cascade]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    shards, cascades = found
    out = np.zeros(len(h1), bool)
    shard = h1 % np.int64(shards)
    for s, cascade in enumerate(cascades):
        own = np.flatnonzero(shard == s)
        if cascade.levels:
            out[own] = cascade.holds(h1[own], h2[own])
    return out


def marked_hosts(pages: DataFrame, words: tuple[str, ...] = BLOCKED_WORDS, url_col: str = "url") -> DataFrame:
    """The sites of the corpus with a label that has one of the words between hyphens: host from that label on."""
    host = host_of(F.col(url_col).cast("string"))
    pattern = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\..+)$"
    return pages.select(F.regexp_extract(host, pattern, 1).alias("host")).filter("host != ''").distinct()


def query(spark, sf_dir: str) -> DataFrame:
    """Verdicts of all pages under the rules and the list of marked hosts."""
    pages = ensure_session(spark).read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge(pages, rules, marked_hosts(pages))


_WORDS = "|".join(BLOCKED_WORDS)
SQL = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN concat('.', host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN concat('.', host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN concat('.', host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN concat('.', host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN concat('.', host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|\.)([^.]*-)?({_WORDS})(-[^.]*)?\..+$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""
