"""Approximate nearest neighbours by learned partitions.

Fitting works on bounded samples. Per node of a tree (one root for each vector
length) up to ``SAMPLE_ROWS`` vectors form a graph of ``GRAPH_K`` nearest
neighbours; the graph is cut into balanced parts (spectral bisections, refined
by swaps that keep both sizes), and a network with one hidden layer learns which
parts a vector and its neighbours lie in. Nodes of one level are fitted in
parallel, and a node with over ``2 * LEAF_ROWS`` rows is divided further, up to
``MAX_MODELS`` classifiers in all, unless it kept more than ``SAME`` of its
parent's rows: equal vectors can't be told apart. The classifiers are all that
is broadcast.

Every row is indexed: the classifiers lead it to its most probable leaf, and a
leaf's rows are stored packed. A query goes to its most probable leaves and is
compared there with all vectors, in double precision. How many leaves that are
is measured: for ``CHECKED`` rows the true neighbours are found among all rows,
and the least number that brings ``RECALL`` of them is taken, all leaves if need
be. A leaf is cut into a grid of ``CELL_ROWS`` candidates by ``CELL_QUERIES``
queries, so a leaf with a third of all rows is many tasks. Of rows with one
vector a leaf keeps, per task, the ``k + 1`` smallest ids: no other can be near.

Defined results: rows whose id or vector is null, and vectors that are empty,
zero or hold null, NaN or infinite components, take no part. Vectors of another
length are no candidates. A row that repeats id and vector counts once; rows
with the query's id are no candidates of it. Equal distances go by the smaller
id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import cut_lineage, ensure_session

K = 10
GRAPH_K = 30
SAMPLE_ROWS = 4096
MAX_PARTS = 32
LEAF_ROWS = 1024
SAME = 0.8
# Classifiers in all: some 50 KB each at 64 components.
MAX_MODELS = 1 + 32 + 32 * 32
HIDDEN = 64
EPOCHS = 10
# Share of the true neighbours that the probed leaves must hold, and the rows it is measured on.
RECALL = 0.95
CHECKED = 256
CELL_ROWS, CELL_QUERIES = 1 << 16, 1 << 12
BLOCK_ROWS = 1 << 14
BATCH_ROWS = 4096


@dataclass
class Tree:
    roots: dict = field(default_factory=dict)  # vector length -> node
    models: dict = field(default_factory=dict)  # node -> (first child, classifier)
    size: int = 0

    def add(self, n: int) -> int:
        self.size += n
        return self.size - n


# ---- vectors ----------------------------------------------------------------------------------------


def valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part; ``v`` holds doubles."""
    ensure_session(rows.sparkSession)
    v = F.col("v")
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return picked.filter(F.col("vec_id").isNotNull() & usable & F.exists(v, lambda x: x != 0))


def matrices(batch: pa.RecordBatch):
    """(rows of the batch, their vectors as a matrix) for each vector length."""
    vectors = batch.column("v")
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vec_id").to_numpy(zero_copy_only=False)


def nearest(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """(query, candidate, distance) of each query's ``k`` nearest; ``own`` ids are left out, ties go by id.

    Products find which candidates can be among the nearest, differences give their distances.
    """
    out = []
    norms = (vectors * vectors).sum(1)
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        with np.errstate(all="ignore"):
            size = (q * q).sum(1)
            close = size[:, None] + norms - 2 * (q @ vectors.T)
            close[ids == own[at : at + 256, None]] = np.inf
            slack = 1e-13 * q.shape[1] * (size + norms.max())
            close[np.isnan(close)] = -np.inf
            limit = np.partition(close, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1] + 2 * slack
            row, col = np.nonzero(close <= np.where(np.isfinite(limit), limit, np.inf)[:, None])
        other = ids[col] != own[at + row]
        row, col = row[other], col[other]
        for s in range(0, len(row), 1 << 16):
            r, c = row[s : s + (1 << 16)], col[s : s + (1 << 16)]
            with np.errstate(all="ignore"):
                out.append((at + r, c, np.sqrt(((q[r] - vectors[c]) ** 2).sum(1))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, col, far = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((ids[col], far, row))
    row, col, far = row[order], col[order], far[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep], col[keep], far[keep]


# ---- fitting a node ---------------------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of the edges to the ``k`` nearest other rows."""
    n = len(x)
    k = min(k, n - 1)
    norms, ends = (x * x).sum(1), []
    for s in range(0, n, 1024):
        close = norms - 2 * (x[s : s + 1024] @ x.T)
        close[np.arange(len(close)), s + np.arange(len(close))] = np.inf
        ends.append(np.argpartition(close, k - 1, axis=1)[:, :k])
    return np.repeat(np.arange(n), k), np.concatenate(ends).ravel()


def bisect(a: np.ndarray, b: np.ndarray, n: int, first: int) -> np.ndarray:
    """A side (0 or 1) per node, ``first`` nodes on side 0, cutting few of the edges (a, b).

    The start follows the second eigenvector of the graph's walk; then pairs
    of nodes swap sides while that cuts fewer edges.
    """
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    weight = np.sqrt(degree)
    v = np.random.default_rng(n).standard_normal(n)
    for _ in range(60):
        v = v - weight * (v @ weight) / (weight @ weight)
        v = 0.5 * v + 0.5 * np.bincount(a, v[b] / weight[b], n) / weight
        v /= np.abs(v).max() or 1.0
    side = np.ones(n, np.int8)
    side[np.argsort(v / weight, kind="stable")[:first]] = 0
    cut = np.count_nonzero(side[a] != side[b])
    for _ in range(30):
        gain = np.bincount(a, np.where(side[a] != side[b], 1, -1), n)
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right))
        good = np.count_nonzero(gain[left[:pairs]] + gain[right[:pairs]] > 0)
        while good:
            tried = side.copy()
            tried[left[:good]], tried[right[:good]] = 1, 0
            now = np.count_nonzero(tried[a] != tried[b])
            if now < cut:
                side, cut = tried, now
                break
            good //= 2
        if not good:
            break
    return side


def balanced_parts(a: np.ndarray, b: np.ndarray, n: int, parts: int) -> np.ndarray:
    """A part per node by repeated bisection; sizes differ by one."""
    out = np.zeros(n, np.int64)
    todo = [(np.arange(n), a, b, 0, parts)]
    while todo:
        nodes, a, b, start, count = todo.pop()
        if count == 1:
            out[nodes] = start
            continue
        half = count // 2
        side = bisect(a, b, len(nodes), len(nodes) * half // count)
        for s, first, m in ((0, start, half), (1, start + half, count - half)):
            inside = (side[a] == s) & (side[b] == s)
            number = np.cumsum(side == s) - 1
            todo.append((nodes[side == s], number[a[inside]], number[b[inside]], first, m))
    return out


def train(x: np.ndarray, target: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """A network with one hidden layer for the shares ``target``, by stochastic gradients with moments."""
    rng = np.random.default_rng(len(x))
    centre, scale = x.mean(0), np.sqrt(((x - x.mean(0)) ** 2).mean()) or 1.0
    x = (x - centre) / scale
    d, m = x.shape[1], target.shape[1]
    net = {"w1": rng.standard_normal((d, HIDDEN)) / np.sqrt(d), "b1": np.zeros(HIDDEN), "w2": rng.standard_normal((HIDDEN, m)) / np.sqrt(HIDDEN), "b2": np.zeros(m), "w3": np.zeros((d, m))}
    first, second, step = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 0.01 * (1 - epoch / epochs)
        for s in range(0, len(x), 128):
            part = order[s : s + 128]
            own, want = x[part], target[part]
            hidden = np.maximum(own @ net["w1"] + net["b1"], 0)
            p = softmax(hidden @ net["w2"] + own @ net["w3"] + net["b2"])
            off = (p - want) / len(part)
            back = (off @ net["w2"].T) * (hidden > 0)
            slopes = {"w1": own.T @ back, "b1": back.sum(0), "w2": hidden.T @ off, "b2": off.sum(0), "w3": own.T @ off}
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net | {"centre": centre, "scale": np.array([scale])}


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def log_shares(net: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    x = (x - net["centre"]) / net["scale"][0]
    z = np.maximum(x @ net["w1"] + net["b1"], 0) @ net["w2"] + x @ net["w3"] + net["b2"]
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def fit_node(x: np.ndarray, parts: int) -> dict[str, np.ndarray]:
    """Graph, balanced parts and classifier of a sample."""
    a, b = neighbour_graph(x, GRAPH_K)
    part = balanced_parts(a, b, len(x), parts)
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1.0
    np.add.at(target, (a, part[b]), 1.0)
    return train(x, target / target.sum(1, keepdims=True))


# ---- the tree ---------------------------------------------------------------------------------------


def leaves(tree: Tree, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for the ``width`` most probable leaves of every row, most probable first."""
    row, node, share = np.arange(len(x)), np.full(len(x), tree.roots.get(x.shape[1], -1)), np.zeros(len(x))
    while True:
        inner = np.isin(node, list(tree.models))
        if not inner.any():
            return row, node
        found = [(row[~inner], node[~inner], share[~inner])]
        for n in np.unique(node[inner]):
            at = np.flatnonzero(node == n)
            child, net = tree.models[n]
            own = log_shares(net, x[row[at]])
            m = min(width, own.shape[1])
            best = np.argsort(-own, axis=1, kind="stable")[:, :m]
            found.append((np.repeat(row[at], m), (child + best).ravel(), np.repeat(share[at], m) + np.take_along_axis(own, best, 1).ravel()))
        row, node, share = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((node, -share, row))
        row, node, share = row[order], node[order], share[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < width
        row, node, share = row[keep], node[keep], share[keep]


def _with_leaf(tree):
    """Rows (vec_id, v) with their leaf; rows of unknown lengths have -1."""

    def run(batches):
        for batch in batches:
            leaf = np.full(batch.num_rows, -1)
            for at, x in matrices(batch):
                leaf[at] = leaves(tree.value, x, 1)[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], [*batch.schema.names, "leaf"])

    return run


def _routed(rows: DataFrame, tree: Tree) -> DataFrame:
    return rows.mapInArrow(_with_leaf(rows.sparkSession.sparkContext.broadcast(tree)), "vec_id long, v array<double>, leaf long")


def _train_group(table: pa.Table) -> pa.Table:
    batch = table.combine_chunks().to_batches()[0]
    _, x = next(matrices(batch))
    order = np.argsort(ids_of(batch), kind="stable")  # what arrives in another order trains the same network
    net = fit_node(x[order], batch.column("parts")[0].as_py())
    data = [[net[k].astype(np.float32).ravel().tolist() for k in NET]]
    return pa.table({"leaf": pa.array([batch.column("leaf")[0].as_py()], pa.int64()), "net": pa.array(data, pa.list_(pa.list_(pa.float32())))})


NET = ("w1", "b1", "w2", "b2", "w3", "centre", "scale")


def _net(rows: list, d: int, parts: int) -> dict[str, np.ndarray]:
    shapes = {"w1": (d, HIDDEN), "w2": (HIDDEN, parts), "w3": (d, parts)}
    return {k: np.array(r).reshape(shapes.get(k, -1)) for k, r in zip(NET, rows)}


def fit(rows: DataFrame) -> Tree:
    """The tree over the stored vectors ``rows``; the driver gets one row a node."""
    tree, lengths, above = Tree(), {}, {}
    for d, _ in rows.groupBy(F.size("v")).count().collect():
        tree.roots[d] = tree.add(1)
        lengths[tree.roots[d]] = d
    fresh = set(tree.roots.values())
    while fresh:
        routed = _routed(rows, tree)
        counts = {r["leaf"]: r["count"] for r in routed.groupBy("leaf").count().collect() if r["leaf"] in fresh}
        large = sorted((n for n in counts if counts[n] > 2 * LEAF_ROWS and counts[n] <= SAME * above.get(n, float("inf"))), key=lambda n: -counts[n])[: MAX_MODELS - len(tree.models)]
        if not large:
            break
        parts = {n: int(min(MAX_PARTS, -(-counts[n] // LEAF_ROWS))) for n in large}
        # Some four times the sample by hash, of which the first by rank are taken.
        share = [(n, parts[n], min(1.0, 4 * SAMPLE_ROWS / counts[n])) for n in large]
        wanted = F.broadcast(rows.sparkSession.createDataFrame(share, "leaf long, parts int, share double"))
        h = F.xxhash64("vec_id", "v")
        drawn = routed.join(wanted, "leaf").withColumn("h", h).filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        ranked = drawn.withColumn("n", F.row_number().over(Window.partitionBy("leaf").orderBy("h", "vec_id"))).filter(F.col("n") <= SAMPLE_ROWS)
        nets = ranked.select("leaf", "parts", "vec_id", "v").groupBy("leaf").applyInArrow(_train_group, "leaf long, net array<array<float>>").collect()
        fresh = set()
        for leaf, net in nets:
            child = tree.add(parts[leaf])
            tree.models[leaf] = (child, _net(net, lengths[leaf], parts[leaf]))
            for n in range(child, child + parts[leaf]):
                lengths[n], above[n] = lengths[leaf], counts[leaf]
                fresh.add(n)
    return tree


# ---- search -----------------------------------------------------------------------------------------


def _best(k: int, queries, tree=None):
    """Rows to each broadcast query's ``k`` nearest of the task, with their leaf if a tree is given."""

    def run(batches):
        ids, vectors = queries.value
        held: dict[int, list] = {}
        for batch in batches:
            mine = ids_of(batch)
            for at, x in matrices(batch):
                same = [i for i, v in enumerate(vectors) if len(v) == x.shape[1]]
                if not same:
                    continue
                q, own = np.array([vectors[i] for i in same]), np.array([ids[i] for i in same])
                row, col, far = nearest(q, own, mine[at], x, k)
                leaf = leaves(tree.value, x[col], 1)[1]
                for r, i, f, n in zip(row.tolist(), mine[at][col].tolist(), far.tolist(), leaf.tolist()):
                    held.setdefault(same[r], []).append((f, i, n))
            held = {r: sorted(set(found))[:k] for r, found in held.items()}
        flat = [(r, i, f, n) for r, found in held.items() for f, i, n in found]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat)], ["query", "vec_id", "score", "leaf"])

    return run


def probes(rows: DataFrame, tree: Tree, k: int = K, recall: float = RECALL) -> tuple[int, float]:
    """(leaves to probe, the recall measured with them) from ``CHECKED`` rows and their true neighbours among all rows."""
    if not tree.models:
        return 1, 1.0
    total = rows.count()
    h = F.pmod(F.xxhash64("v", "vec_id"), F.lit(1 << 30))
    few = rows.filter(h < max(1.0, 8 * CHECKED / total * (1 << 30))) if total > 8 * CHECKED else rows
    picked = few.orderBy(h, "vec_id").limit(CHECKED).collect()
    context = rows.sparkSession.sparkContext
    ids, vectors = [r["vec_id"] for r in picked], [np.array(r["v"]) for r in picked]
    found = rows.mapInArrow(_best(k, context.broadcast((ids, vectors)), context.broadcast(tree)), "query long, vec_id long, score double, leaf long")
    first = Window.partitionBy("query").orderBy("score", "vec_id")
    true = found.distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).select("query", "leaf").collect()
    all_leaves = tree.size - len(tree.models)
    width = 1
    while True:
        hit = 0
        reach = [set(leaves(tree, v[None, :], width)[1].tolist()) for v in vectors]
        hit = sum(leaf in reach[q] for q, leaf in true)
        if hit >= recall * len(true) or width >= all_leaves:
            return width, hit / max(len(true), 1)
        width = min(all_leaves, max(width + 1, int(width * 1.15)))


def _packed(leaf: int, ids: np.ndarray, x: np.ndarray):
    return leaf, len(ids), ids.astype("<i8").tobytes(), np.ascontiguousarray(x, "<f8").tobytes()


_BLOCK = "leaf long, n int, ids binary, vectors binary"
_NAMES = ["leaf", "n", "ids", "vectors"]
_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def distinct_near(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among anyone's ``k`` nearest: of equal vectors the ``k + 1`` smallest ids."""
    _, same = np.unique(np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    ids, same = ids[order], same[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (same[1:] != same[:-1])
    order, same = order[fresh], same[fresh]
    return order[np.arange(len(order)) - np.searchsorted(same, same) <= k]


def _pack(tree, k: int):
    """Rows to packed leaves; a task holds ``BLOCK_ROWS`` rows before it sends them."""

    def send(held):
        for leaf, parts in held.items():
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            keep = distinct_near(ids, x, k)
            yield _batch([_packed(leaf, ids[keep], x[keep])])

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            ids = ids_of(batch)
            for at, x in matrices(batch):
                _, leaf = leaves(tree.value, x, 1)
                for n in np.unique(leaf).tolist():
                    held.setdefault(n, []).append((ids[at][leaf == n], x[leaf == n]))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield from send(held)
                held, size = {}, 0
        yield from send(held)

    return run


def _ask(tree, width: int):
    """Query rows to packed requests, one row per leaf and batch."""

    def run(batches):
        for batch in batches:
            ids = ids_of(batch)
            for at, x in matrices(batch):
                row, leaf = leaves(tree.value, x, width)
                order = np.argsort(leaf, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
                    if len(part):
                        yield _batch([_packed(int(leaf[part[0]]), ids[at][row[part]], x[row[part]])])

    return run


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(b"".join(table["ids"].to_pylist()), "<i8")
    return ids, np.frombuffer(b"".join(table["vectors"].to_pylist()), "<f8").reshape(len(ids), -1)


def _meet(k: int):
    """A cell's candidates and queries to the queries' nearest candidates."""
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.binary()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        if not blocks.num_rows or not asked.num_rows:
            return schema.empty_table()
        (ids, x), (own, q) = _unpacked(blocks), _unpacked(asked)
        row, col, far = nearest(q, own, ids, x, k)
        name = [v.tobytes() for v in q]
        return pa.table([pa.array(own[row]), pa.array([name[r] for r in row.tolist()], pa.binary()), pa.array(ids[col]), pa.array(far)], schema=schema)

    return run


def search(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each query found in its most probable leaves."""
    conf, limit = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(limit)) <= BATCH_ROWS:
        conf.set(limit, str(BATCH_ROWS))
    rows = cut_lineage(valid(rows, id_col, vector_col), "neighbours-rows")
    queries = valid(queries, id_col, vector_col).distinct()
    tree = fit(rows)
    width, _ = probes(rows, tree, k)
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(tree)
    blocks = cut_lineage(rows.mapInArrow(_pack(shared, k), _BLOCK), "neighbours-blocks")
    asked = cut_lineage(queries.mapInArrow(_ask(shared, width), _BLOCK), "neighbours-asked")
    # One row a leaf: how many cells of candidates and of queries it has.
    sizes = blocks.groupBy("leaf").agg(F.sum("n").alias("rows")).join(asked.groupBy("leaf").agg(F.sum("n").alias("asks")), "leaf")
    cells = sizes.select("leaf", F.ceil(F.col("rows") / CELL_ROWS).alias("down"), F.ceil(F.col("asks") / CELL_QUERIES).alias("across"))
    cells = F.broadcast(cut_lineage(cells, "neighbours-cells"))  # at most MAX_MODELS * MAX_PARTS rows and one per vector length
    here = F.xxhash64("ids", "vectors")
    left = blocks.join(cells, "leaf").withColumns({"i": F.pmod(here, F.col("down")), "j": F.explode(F.sequence(F.lit(0), F.col("across") - 1))})
    right = asked.join(cells, "leaf").withColumns({"j": F.pmod(here, F.col("across")), "i": F.explode(F.sequence(F.lit(0), F.col("down") - 1))})
    key = ["leaf", "i", "j"]
    left, right = (side.select(*[F.col(c).cast("long") for c in key], "ids", "vectors") for side in (left, right))
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_meet(k), "query_id long, query binary, vec_id long, score double")
    ranked = met.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100."""
    rows = ensure_session(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(rows, rows.filter(F.col("vec_id") % 100 == 0))
