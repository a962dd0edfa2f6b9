"""Near-duplicate embeddings by a forest of random-projection trees.

1. Equal vectors are one class from the start, so copies are compared once.
2. Every tree splits the unit vectors by random directions, again and again. A
   split sends what lies between two quantiles to both sides (spill), so that
   close vectors on either side of it still meet. Of ``DIRECTIONS`` directions
   and a few quantiles that split is taken whose overlap is widest in distance.
   Quantiles come from a bounded sample of a node (``ROOT_SAMPLE`` classes of a
   root, ``NODE_SAMPLE`` of a later node); every vector is routed. Nodes with
   more than twice ``leaf`` classes are sampled and split again, round by round.
3. A node where at least ``DENSE`` of the sampled pairs link is not split any
   further, whatever its size: it is compared whole, block by block, so no
   group of near copies loses links to the splits.
4. In a leaf all pairs are compared in double precision. A pair that meets in
   several leaves counts in the first of them only (by the leaves both hold).
   What leaves a task are numbers of links and one edge per class, never pairs.
5. The edges' connected components are the groups.

Links are verified, so none is below the threshold; pairs that no leaf brings
together are missed (the tests hold the recall against all pairs).

Defined cases: a null or empty vector, one with a null or non-finite component
and the zero vector link with nothing and are their own component, with 0
links. Vectors of different lengths are not linked; the number of different
lengths is taken to be small. Rows with a null id take no part: 0 links, null
component. Rows of one id are separate vectors with the same name, repeated
rows too; each counts the others. Names of other columns do not matter, an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_features.llm.components import components
from merchant_features.llm.groups import first_shared, reachable
from merchant_features.sources.storage import materialize

TREES = 6
#: Classes of a leaf, about.
LEAF = 512
#: Share of a node's vectors that goes to both sides of a split, by half.
SPILL = 0.03
DIRECTIONS = 6
CENTRES = (0.4, 0.45, 0.5, 0.55, 0.6)
#: Sampled vectors that a split must leave on either side.
LEAST_SAMPLE = 24
ROOT_SAMPLE = 16_384
NODE_SAMPLE = 512
#: Share of linked pairs beyond which a node is compared whole; pairs of at most so many sampled vectors are looked at.
DENSE = 0.05
DENSE_SAMPLE = 256
#: Larger leaves are compared in blocks of about so many classes.
BLOCK = 2048
#: Nodes are numbered like a heap in 62 bits.
DEEPEST = 1 << 60


def _matrix(blobs: pa.Array, dim: int, kind: str) -> np.ndarray:
    """Rows of doubles, scaled by powers of two so that no square overflows or vanishes."""
    raw = np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(len(blobs), dim).astype(np.float64)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _direction(dim: int, tree: int, node: int, k: int) -> np.ndarray:
    own = np.random.Generator(np.random.PCG64([dim, tree, node, k])).standard_normal(dim)
    return own / np.sqrt((own * own).sum())


def _dense(u: np.ndarray, threshold: float) -> bool:
    some = u[:DENSE_SAMPLE]
    n = len(some)
    return n > 1 and ((some @ some.T >= threshold).sum() - n) >= DENSE * n * (n - 1)


def _grow(u: np.ndarray, n: int, tree: int, root: int, leaf: int, threshold: float) -> list[tuple[int, int, float, float]]:
    """Splits (node, direction, low, high) below ``root`` from a sample ``u`` of its ``n`` vectors; direction -1: done."""
    plan, open_nodes = [], [(root, np.arange(len(u)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        own = u[rows]
        if len(rows) * n <= leaf * len(u) or len(rows) < 2 * LEAST_SAMPLE:
            continue
        if node >= DEEPEST or _dense(own, threshold):
            plan.append((node, -1, 0.0, 0.0))
            continue
        best = None
        for k in range(DIRECTIONS):
            at = own @ _direction(u.shape[1], tree, node, k)
            bounds = np.quantile(at, [c + s for c in CENTRES for s in (-SPILL, SPILL)]).reshape(-1, 2)
            widest = int(np.argmax(bounds[:, 1] - bounds[:, 0]))
            low, high = bounds[widest]
            if best is None or high - low > best[0]:
                best = (high - low, k, float(low), float(high), at)
        _, k, low, high, at = best
        left, right = rows[at <= high], rows[at > low]
        if len(left) == len(rows) or len(right) == len(rows):
            plan.append((node, -1, 0.0, 0.0))
            continue
        plan.append((node, k, low, high))
        open_nodes += [(2 * node, left), (2 * node + 1, right)]
    return plan


def _routed(u: np.ndarray, tree: int, root: int, splits: dict) -> Iterator[tuple[np.ndarray, int, bool]]:
    """(rows, node, whether the node is done) for every node that the rows end in."""
    open_nodes = [(root, np.arange(len(u)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        k, low, high = splits.get(node, (None, 0.0, 0.0))
        if k is None or k < 0:
            if len(rows):
                yield rows, node, k is not None
            continue
        at = u[rows] @ _direction(u.shape[1], tree, node, k)
        open_nodes += [(2 * node, rows[at <= high]), (2 * node + 1, rows[at > low])]


def _classified(vectors: DataFrame, kind: str) -> DataFrame:
    """(id, cls, dim, vec): class and bytes of every usable vector, else null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            numbers = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(kind) + 0
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
            classes, dims, blobs = [], [], []
            for low, high in zip(ends[:-1], ends[1:], strict=True):
                own = numbers[low:high]
                usable = high > low and bool(np.isfinite(own).all()) and bool(own.any())
                blob = own.tobytes() if usable else None
                classes.append(hashlib.blake2b(blob, digest_size=16).digest() if usable else None)
                dims.append(int(high - low) if usable else None)
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.binary()), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())],
                ["id", "cls", "dim", "vec"],
            )

    id_type = dict(vectors.dtypes)["id"]
    return vectors.mapInArrow(read, f"id {id_type}, cls binary, dim int, vec binary")


_PLAN = "dim int, tree int, root bigint, node array<bigint>, k array<int>, low array<double>, high array<double>"


def _subtrees(sampled: DataFrame, kind: str, leaf: int, threshold: float) -> DataFrame:
    """Splits of every node; ``sampled`` has dim, tree, root, n and vec."""

    def grown(group: pa.Table) -> pa.Table:
        dim, tree, root, n = (group.column(c)[0].as_py() for c in ("dim", "tree", "root", "n"))
        vec = group.column("vec").combine_chunks()
        u = _unit(_matrix(vec, dim, kind))
        order = np.argsort([hashlib.blake2b(v.as_py(), digest_size=8).digest() for v in vec], kind="stable")
        plan = _grow(u[order], n, tree, root, leaf, threshold)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()), "tree": pa.array([tree], pa.int32()), "root": pa.array([root], pa.int64()),
                "node": pa.array([[p[0] for p in plan]], pa.list_(pa.int64())),
                "k": pa.array([[p[1] for p in plan]], pa.list_(pa.int32())),
                "low": pa.array([[p[2] for p in plan]], pa.list_(pa.float64())),
                "high": pa.array([[p[3] for p in plan]], pa.list_(pa.float64())),
            }
        )

    return materialize(sampled.select("dim", "tree", "root", "n", "vec").groupBy("dim", "tree", "root").applyInArrow(grown, _PLAN))


_PLACED = "cls binary, dim int, vec binary, tree int, node bigint, done boolean"


def _placed_batch(batch: pa.RecordBatch, out: list) -> pa.RecordBatch:
    """Rows of ``batch`` (cls, dim, vec first) taken and named as ``out`` says: (rows, tree, node, done)."""
    rows = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
    counts = [len(o[0]) for o in out]
    taken = [batch.column(c).take(pa.array(rows)) for c in range(3)]
    return pa.RecordBatch.from_arrays(
        [
            *taken, pa.array(np.repeat([o[1] for o in out], counts).astype(np.int32)),
            pa.array(np.repeat([o[2] for o in out], counts).astype(np.int64)),
            pa.array(np.repeat([o[3] for o in out], counts).astype(bool)),
        ],
        ["cls", "dim", "vec", "tree", "node", "done"],
    )


def _by_roots(classes: DataFrame, plans: list, kind: str) -> DataFrame:
    """All classes routed through the trees of their length; lengths without a tree are one leaf."""
    trees: dict[int, dict[int, dict]] = {}
    for p in plans:
        splits = {n: (k, a, b) for n, k, a, b in zip(p["node"], p["k"], p["low"], p["high"], strict=True)}
        if splits.get(1, (0,))[0] >= 0 or p["tree"] == 0:  # a root that is compared whole needs one tree
            trees.setdefault(p["dim"], {})[p["tree"]] = splits
    sent = classes.sparkSession.sparkContext.broadcast(trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            out = []
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim not in sent.value:
                    out.append((at, 0, 1, True))
                    continue
                u = _unit(_matrix(batch.column(2).take(pa.array(at)), dim, kind))
                for tree, splits in sent.value[dim].items():
                    out += [(at[rows], tree, node, done) for rows, node, done in _routed(u, tree, 1, splits)]
            yield _placed_batch(batch, out)

    return materialize(classes.select("cls", "dim", "vec").mapInArrow(route, _PLACED))


def _split_again(placed: DataFrame, full: DataFrame, kind: str, leaf: int, threshold: float) -> DataFrame:
    """Rows of over-full nodes, routed one plan deeper; ``full`` has dim, tree, node, n."""
    key = ["dim", "tree", "node"]
    inside = placed.join(full, key)
    sampled = inside.where(
        F.pmod(F.xxhash64("cls", "node"), F.lit(1 << 30)) * F.col("n") < F.lit(NODE_SAMPLE << 30)
    ).withColumnRenamed("node", "root")
    plans = _subtrees(sampled, kind, leaf, threshold).select(
        "dim", "tree", F.col("root").alias("node"), F.struct("node", "k", "low", "high").alias("plan")
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, nodes, dims = (batch.column(c).to_numpy() for c in (3, 4, 1))
            where = np.unique(np.stack([trees.astype(np.int64), nodes, dims.astype(np.int64)]), axis=1, return_inverse=True)[1].ravel()
            out = []
            for which in range(int(where.max()) + 1 if len(where) else 0):
                at = np.flatnonzero(where == which)
                tree, node, dim = int(trees[at[0]]), int(nodes[at[0]]), int(dims[at[0]])
                plan = batch.column(5)[int(at[0])].as_py()
                splits = {}
                if plan:
                    splits = {n: (k, a, b) for n, k, a, b in zip(plan["node"], plan["k"], plan["low"], plan["high"], strict=True)}
                if node not in splits:  # the sample asks for no split: compared whole
                    out.append((at, tree, node, True))
                    continue
                u = _unit(_matrix(batch.column(2).take(pa.array(at)), dim, kind))
                out += [(at[rows], tree, n, done) for rows, n, done in _routed(u, tree, node, splits)]
            yield _placed_batch(batch, out)

    rows = inside.join(plans, key, "left").select("cls", "dim", "vec", "tree", "node", "plan")
    return materialize(rows.mapInArrow(route, _PLACED))


def _leaves(classes: DataFrame, kind: str, threshold: float, trees: int, leaf: int) -> DataFrame:
    """(cls, dim, vec, tree, node, n): every class in the leaves it belongs to, with their sizes."""
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * leaf)
    sampled = classes.join(sizes, "dim").where(
        F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) * F.col("n") < F.lit(ROOT_SAMPLE << 30)
    ).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("root", F.lit(1).cast("long"))
    placed = _by_roots(classes, _subtrees(sampled, kind, leaf, threshold).collect(), kind)
    ended = None
    while True:
        counts = materialize(placed.groupBy("dim", "tree", "node").agg(F.count(F.lit(1)).alias("n"), F.bool_or("done").alias("whole")))
        full = counts.where(~F.col("whole") & (F.col("n") > 2 * leaf)).select("dim", "tree", "node", "n")
        here = placed.join(
            counts.where(F.col("whole") | (F.col("n") <= 2 * leaf)).select("dim", "tree", "node", "n"), ["dim", "tree", "node"]
        ).select("cls", "dim", "vec", "tree", "node", "n")
        ended = here if ended is None else ended.unionByName(here)
        if full.isEmpty():
            return ended
        placed = _split_again(placed, full, kind, leaf, threshold)


def _compared(leaves: DataFrame, copies: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(cls, others, root): documents linked to a class in a leaf, and the class it hangs on there; written once."""
    key = F.xxhash64("dim", "tree", "node")
    keyed = materialize(leaves.select("cls", "dim", "vec", key.alias("leaf"), F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")))
    held = keyed.groupBy("cls").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    held = held.join(copies.select("cls", "copies"), "cls")
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    blocks = keyed.join(held, "cls").withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    blocks = blocks.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))

    def compare(group: pa.Table) -> pa.Table:
        leaf, dim = group.column("leaf")[0].as_py(), group.column("dim")[0].as_py()
        part, low = group.column("part").to_numpy(), group.column("low")[0].as_py()
        raw = _matrix(group.column("vec").combine_chunks(), dim, kind)
        u, x = _unit(raw), np.flatnonzero(part == low)
        alone = len(x) == len(part)
        y = x if alone else np.flatnonzero(part != low)
        found = [np.zeros((2, 0), np.int64)]
        for first in range(0, len(x), 512):
            some = x[first : first + 512]
            a, b = np.nonzero(u[some] @ u[y].T >= threshold - 1e-9)
            found.append(np.stack([some[a], y[b]]))
        i, j = np.concatenate(found, axis=1)
        if alone:
            i, j = i[i < j], j[i < j]
        exact = (raw[i] * raw[j]).sum(1) / (np.sqrt((raw[i] ** 2).sum(1)) * np.sqrt((raw[j] ** 2).sum(1))) if len(i) else np.zeros(0)
        i, j = i[exact >= threshold], j[exact >= threshold]
        if len(i):
            first = first_shared(leaf, group.column("leaves").combine_chunks(), i, j)
            i, j = i[first], j[first]
        n, copies = len(part), group.column("copies").to_numpy()
        others = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        label = reachable(n, i, j)
        told = np.flatnonzero(others > 0)
        classes = group.column("cls").combine_chunks()
        return pa.table(
            {
                "cls": classes.take(pa.array(told)), "others": pa.array(others[told].astype(np.int64)),
                "root": classes.take(pa.array(label[told])),
            }
        )

    return materialize(
        blocks.groupBy("leaf", "low", "high").applyInArrow(compare, "cls binary, others bigint, root binary")
    )


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
    trees: int = TREES, leaf: int = LEAF,
) -> DataFrame:
    """(id, n_links, component) of every row: other vectors linked directly, smallest id reachable by links."""
    element = vectors.schema[vector_col].dataType.elementType
    kind = "f4" if isinstance(element, T.FloatType) else "f8"
    vector = F.col(f"`{vector_col}`").cast("array<float>" if kind == "f4" else "array<double>")
    rows = materialize(_classified(vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector")), kind))
    named = rows.where("id IS NOT NULL AND cls IS NOT NULL")
    classes = materialize(
        named.groupBy("cls").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"), F.first("vec").alias("vec")
        )
    )
    told = _compared(_leaves(classes, kind, threshold, trees, leaf), classes, kind, threshold)
    others = told.groupBy("cls").agg(F.sum("others").alias("others"))
    joined = components(told.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    of_class = materialize(
        classes.select("cls", "least", "copies")
        .join(others, "cls", "left")
        .join(joined.withColumnsRenamed({"node": "cls", "component": "root"}), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    )
    names = of_class.groupBy("root").agg(F.min("least").alias("component"))
    answer = materialize(of_class.join(names, "root").select("cls", "n_links", "component"))
    found = rows.join(answer, "cls", "left")
    return found.select(
        "id",
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
    )
