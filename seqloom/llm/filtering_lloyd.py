"""Codes of vectors by product quantisation, its codebooks fitted by the filtering form of Lloyd's rounds.

Vectors are cut into parts; blocks of rows are kept as kd-trees, one for each part position, with the box, the sum and
the count of every node. A round walks the trees from their roots with the codebook's entries: one that can't be the
nearest anywhere in a node's box is left out below it, and where a single one remains the whole subtree is assigned at
once. All numbers are integers, so results don't depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows of a block of trees, and points of a leaf at most.
BLOCK, LEAF = 8192, 32
#: Components are clamped here, so that they fit a long; distances beyond a long are reported as the largest long.
LARGEST = 1 << 62
#: Label sums are broadcast up to so many labels.
BROADCAST_LABELS = 100_000


@dataclass
class Tree:
    """A balanced kd-tree: level l has 2^l nodes, node k of it holds order[starts[l][k]:starts[l][k + 1]]."""

    order: np.ndarray
    points: np.ndarray
    starts: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @staticmethod
    def built(points: np.ndarray) -> Tree:
        n = len(points)
        depth = max(0, int(np.ceil(np.log2(max(1, n / LEAF)))))
        order = np.arange(n)
        starts = []
        for level in range(depth + 1):
            at = (np.arange((1 << level) + 1) * n) >> level
            starts.append(at)
            if level < depth:
                now = points[order]
                widest = (np.maximum.reduceat(now, at[:-1]).astype(float) - np.minimum.reduceat(now, at[:-1])).argmax(1)
                node = np.repeat(np.arange(1 << level), np.diff(at))
                order = order[np.lexsort((now[np.arange(n), widest[node]], node))]
        tree = Tree(order, points[order], starts, [], [], [])
        tree.measure()
        return tree

    def measure(self) -> None:
        """Boxes and sums of all nodes, from the leaves up."""
        exact = self.points if fits(len(self.points), self.points) else self.points.astype(object)
        low, high, sums = (f.reduceat(x, self.starts[-1][:-1]) for f, x in ((np.minimum, self.points), (np.maximum, self.points), (np.add, exact)))
        self.low, self.high, self.sums = [low], [high], [sums]
        while len(low) > 1:
            low, high, sums = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), sums[::2] + sums[1::2]
            for kept, now in ((self.low, low), (self.high, high), (self.sums, sums)):
                kept.insert(0, now)


def fits(terms: int, *arrays: np.ndarray) -> bool:
    """Whether sums of so many components, and of eight times their squares over a part, stay within a long."""
    top = max([0, *(max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size)])
    width = max(a.shape[-1] for a in arrays)
    return 8 * top * top * width < 1 << 62 and terms * top < 1 << 62


def walk(tree: Tree, codebook: np.ndarray, whole, single) -> None:
    """Assigns every point of the tree to its nearest entry, ties to the lower index.

    whole(level, nodes, entries) gets subtrees that have one entry left; single(positions, entries) points of leaves.
    """
    exact = fits(len(tree.points), tree.points, codebook)
    kind = np.int64 if exact else object
    book = codebook.astype(kind)
    k = len(book)
    nodes = np.array([0])
    left = np.ones((1, k), bool)
    last = len(tree.starts) - 1
    index = np.arange(k)
    for level in range(last + 1):
        low, high = tree.low[level][nodes].astype(kind), tree.high[level][nodes].astype(kind)
        # The entry nearest to the middle of the box; any choice is right, this one leaves most others out.
        middle = ((low.astype(float) + high.astype(float)) / 2)[:, None, :] - codebook.astype(float)[None]
        best = np.where(left, (middle * middle).sum(2), np.inf).argmin(1)
        star = book[best][:, None, :]
        toward = book[None] - star
        corner = np.where(toward > 0, high[:, None, :], low[:, None, :])
        # How much farther than the chosen entry each other is at the corner of the box that favours it most.
        farther = (toward * (book[None] + star - 2 * corner)).sum(2)
        left &= ~((farther > 0) | ((farther == 0) & (index[None] > best[:, None]))).astype(bool)
        one = left.sum(1) == 1
        if one.any():
            whole(level, nodes[one], left[one].argmax(1))
        nodes, left = nodes[~one], left[~one]
        if not len(nodes):
            return
        if level < last:
            nodes, left = np.stack([2 * nodes, 2 * nodes + 1], 1).ravel(), np.repeat(left, 2, axis=0)
    begins, ends = tree.starts[last][nodes], tree.starts[last][nodes + 1]
    size = ends - begins
    row = np.repeat(np.arange(len(nodes)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + begins[row]
    gap = tree.points[at].astype(kind)[:, None, :] - book[None]
    far = (gap * gap).sum(2)
    far = np.where(left[row], far, far.max() + 1 if far.size else 0)
    single(at, far.argmin(1))


def summed(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points nearest to each entry."""
    sums, counts = np.zeros(codebook.shape, object), np.zeros(len(codebook), np.int64)

    def whole(level, nodes, entries):
        for e in np.unique(entries):
            mine = nodes[entries == e]
            sums[e] += tree.sums[level][mine].sum(0)
            counts[e] += (tree.starts[level][mine + 1] - tree.starts[level][mine]).sum()

    def single(at, entries):
        for e in np.unique(entries):
            mine = tree.points[at[entries == e]]
            sums[e] += (mine if fits(len(mine), mine) else mine.astype(object)).sum(0)
            counts[e] += len(mine)

    walk(tree, codebook, whole, single)
    return sums, counts


def assigned(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each row of the block and its squared distance (Python integers where a long is too small)."""
    entry = np.zeros(len(tree.points), np.int64)

    def whole(level, nodes, entries):
        for node, e in zip(nodes, entries, strict=True):
            entry[tree.starts[level][node] : tree.starts[level][node + 1]] = e

    def single(at, entries):
        entry[at] = entries

    walk(tree, codebook, whole, single)
    kind = np.int64 if fits(1, tree.points, codebook) else object
    gap = tree.points.astype(kind) - codebook.astype(kind)[entry]
    codes, far = np.empty_like(entry), np.empty(len(entry), kind)
    codes[tree.order], far[tree.order] = entry, (gap * gap).sum(1)
    return codes, far


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(vectors.astype(np.float64) * SCALE, -float(LARGEST), float(LARGEST))).astype(np.int64)


TREES = "ids array<long>, labels array<{label}>, points array<binary>, orders array<binary>"


def forest(rows: DataFrame, width: int) -> DataFrame:
    """Blocks of rows (vec_id, label, embedding) as trees: ids and labels, and for each part its points in the order of its tree."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        held, count = [], 0

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = integers(table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), width))
            points, orders = [], []
            for part in np.split(vectors, PARTS, axis=1):
                tree = Tree.built(part)
                points.append(tree.points.astype("<i8").tobytes() if abs(part).max() >= 1 << 31 else tree.points.astype("<i4").tobytes())
                orders.append(tree.order.astype("<i4").tobytes())
            columns = [[table[c].to_pylist()] for c in ("vec_id", "label")] + [[points], [orders]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.list_(pa.int64())), pa.array(columns[1], pa.list_(table["label"].type)), *(pa.array(c, pa.list_(pa.binary())) for c in columns[2:])], names=["ids", "labels", "points", "orders"])

        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                piece = batch.slice(start, BLOCK)
                if count + len(piece) > BLOCK:
                    yield block()
                    held, count = [], 0
                held.append(piece)
                count += len(piece)
        if count:
            yield block()

    return rows.mapInArrow(run, TREES.format(label=label))


def trees_of(batch: pa.RecordBatch, row: int, width: int) -> list[Tree]:
    """The trees of a block; boxes and sums are taken from the points again, which are half the bytes."""
    found = []
    for points, order in zip(batch.column("points")[row], batch.column("orders")[row], strict=True):
        order, points = np.frombuffer(order.as_py(), "<i4"), points.as_py()
        size = len(points) // max(1, len(order) * width // PARTS)
        n = len(order)
        depth = max(0, int(np.ceil(np.log2(max(1, n / LEAF)))))
        tree = Tree(order, np.frombuffer(points, f"<i{size}").astype(np.int64).reshape(n, width // PARTS), [(np.arange((1 << d) + 1) * n) >> d for d in range(depth + 1)], [], [], [])
        tree.measure()
        found.append(tree)
    return found


def next_round(blocks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round: each task sums over its blocks, Spark over tasks; unused entries stay."""

    def run(batches):
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for row in range(len(batch)):
                for part, tree in enumerate(trees_of(batch, row, width)):
                    sums, counts = summed(tree, books[part])
                    for e in np.flatnonzero(counts):
                        at = total.setdefault((part, int(e)), [0, [0] * (width // PARTS)])
                        at[0] += int(counts[e])
                        at[1] = [a + int(b) for a, b in zip(at[1], sums[e], strict=True)]
        flat = [(part, e, place, n, Decimal(value)) for (part, e), (n, values) in total.items() for place, value in enumerate(values)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in flat], kind) for c, kind in enumerate(kinds)], names=["part", "entry", "place", "n", "total"])

    found = blocks.mapInArrow(run, "part int, entry int, place int, n long, total decimal(38,0)")
    after = [b.copy() for b in books]
    for r in found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # one row a component of the codebooks
        after[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return after


def codes(blocks: DataFrame, books: list[np.ndarray], width: int, label: str) -> DataFrame:
    """vec_id, label, code and error of every row of the blocks."""

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
                text, error = [[] for _ in ids], np.zeros(len(ids), object)
                for part, tree in enumerate(trees_of(batch, row, width)):
                    entry, far = assigned(tree, books[part])
                    error += far.astype(object)
                    for out, e in zip(text, entry.tolist(), strict=True):
                        out.append(f"{e:02x}")
                errors = pa.array([min(x, (1 << 63) - 1) for x in error], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(["".join(x) for x in text], pa.string()), errors], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def usable(rows: DataFrame) -> DataFrame:
    """Rows whose vector has finite components only, as many as can be cut into equal parts."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0) & finite)


def sha_of(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def encoded(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code and error of each usable row of rows (vec_id, label, embedding), and the codebooks.

    The codebooks start as the parts of the ENTRIES vectors of least id, as all vectors of the first one's length take part.
    """
    kept = usable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"))
    label = rows.schema["label"].dataType.simpleString()
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = kept.select("vec_id", "embedding").orderBy(*order).limit(1).collect()
    if not first:
        return rows.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long"), []
    width = len(first[0]["embedding"])
    kept = kept.where(F.size("embedding") == width)
    start = integers(np.array([r["embedding"] for r in kept.select("vec_id", "embedding").orderBy(*order).limit(ENTRIES).collect()], np.float64))
    books = np.split(start, PARTS, axis=1)
    blocks = staged(forest(kept, width), "forest")
    for _ in range(rounds):
        books = next_round(blocks, books, width)
    return staged(codes(blocks, books, width, label), "codes"), books


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Eight-part codes of embeddings, with errors by row and label and the digest of the codebooks.

    Rows with a null vector or with null or non-finite components are dropped, as are vectors that can't be cut into eight
    equal parts or are of another length than the kept one of least vec_id. Of fewer than sixteen vectors each is an
    entry. Rows repeated with one vec_id each count and give a row; among them those of the lesser vector come first at the
    start, rows without a vec_id last. Ties between entries go to the lower index. Components are clamped to 2^62 either
    way and errors to the largest long; below 2^28, which is a component of 65,536, nothing is. An empty table gives no
    rows. Other columns are never read.
    """
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    found, books = encoded(rows)
    sums = staged(found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")), "label-errors")
    capped = F.least("total", F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("label_error")
    sums = sums.select(F.col("label").alias("_label"), capped)
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = found.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(sha_of(books)).alias("codebooks_sha256"))


def oracle() -> str:
    """SQL with the same result for vectors of one length: the rounds written out one after the other."""
    steps = [
        "k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE embedding IS NOT NULL "
        "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0)",
        "p AS MATERIALIZED (SELECT vec_id, label, part, list_slice(q, part * (len(q) // 8) + 1, (part + 1) * (len(q) // 8)) AS v FROM k, range(8) r(part))",
        "b0 AS (SELECT part, e - 1 AS entry, v FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS e FROM p) WHERE e <= 16)",
    ]
    near = (
        "SELECT vec_id, any_value(label) AS label, part, any_value(p.v) AS v, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d FROM (SELECT p.vec_id, p.label, p.part, p.v, b.entry, "
        "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{0} b USING (part)) p GROUP BY vec_id, part"
    )
    for n in range(ROUNDS):
        steps.append(f"a{n} AS MATERIALIZED ({near.format(n)})")
        steps.append(
            f"m{n} AS (SELECT part, entry, list(floor_div ORDER BY i) AS v FROM (SELECT part, entry, i, ((s - ((s % c + c) % c)) // c)::BIGINT AS floor_div FROM "
            f"(SELECT part, entry, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS c FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM a{n}) GROUP BY part, entry, i)) GROUP BY part, entry)"
        )
        steps.append(f"b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN m{n} m USING (part, entry))")
    steps.append(f"z AS MATERIALIZED ({near.format(ROUNDS)})")
    steps.append("c AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM z GROUP BY vec_id)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})")
    return "WITH " + ", ".join(steps) + " SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, h"
