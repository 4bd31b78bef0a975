"""Near copies among vectors: random projections decoded to points of the E8 lattice, neighbouring cells probed, cosines verified.

Each table projects a vector to BLOCKS times eight dimensions and takes the nearest lattice point of each eight as its
cell. A vector is at home in one cell of a table and visits the PROBES cells that are next nearest to it. Vectors that
meet in a cell are compared in tiles of bounded size; what they find is summed within the tile, so no pair is ever a row.
A pair that meets in several cells is counted in the first of them, which both vectors' cells tell.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged
from .components import components

COSINE = 0.95
TABLES, BLOCKS, PROBES = 8, 2, 2
#: Lattice cells of a vector of length one; the finer, the fewer strangers share a cell and the more copies part.
FINENESS = 4.0
#: Vectors of a side of a tile, about.
TILE = 768
SEED = 20240


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the ways from a cell to its neighbours."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def even_point(x: np.ndarray) -> np.ndarray:
    """The nearest integer points whose coordinates have an even sum: round, and move the worst coordinate if the sum is odd."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(-1)[..., None]
    step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0) * (near.sum(-1, keepdims=True) % 2 != 0)
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is the even points and the same moved by a half."""
    a, b = even_point(x), even_point(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(-1) <= ((x - b) ** 2).sum(-1))[..., None], a, b)


def mixed(points: np.ndarray) -> np.ndarray:
    """64-bit hashes of doubled lattice points, one for each row."""
    out = np.full(len(points), 0x9E3779B97F4A7C15, np.uint64)
    for column in np.rint(2 * points).astype(np.int64).T.astype(np.uint64):
        out = (out ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


class Lattice:
    """Cells of unit vectors of one length."""

    def __init__(self, width: int):
        rng = np.random.default_rng([SEED, width])
        self.ways = roots()
        self.projections = []
        for _ in range(TABLES):
            g = rng.normal(size=(width, 8 * BLOCKS))
            # Directions at right angles where there are enough; either way lengths keep their scale at any width.
            self.projections.append((np.linalg.qr(g)[0] * np.sqrt(width / 64) if width >= 8 * BLOCKS else g / 8) * FINENESS)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cells (n, TABLES) and visited cells (n, TABLES * PROBES)."""
        n = len(unit)
        homes, visits = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, PROBES), np.int64)
        for t, projection in enumerate(self.projections):
            at = (unit @ projection).reshape(n, BLOCKS, 8)
            point = decode(at)
            homes[:, t] = mixed(point.reshape(n, -1))
            # How near each neighbouring cell is; the nearest few in any block are visited.
            nearness = ((at - point) @ self.ways.T).reshape(n, -1)
            chosen = np.argsort(-nearness, axis=1, kind="stable")[:, :PROBES] if n < 64 else np.argpartition(-nearness, PROBES - 1, axis=1)[:, :PROBES]
            for p in range(PROBES):
                moved = point.copy()
                block, way = np.divmod(chosen[:, p], len(self.ways))
                moved[np.arange(n), block] += self.ways[way]
                visits[:, t, p] = mixed(moved.reshape(n, -1))
        return homes, visits.reshape(n, -1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one in double precision; large and tiny components don't overflow."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def located(vectors: DataFrame) -> DataFrame:
    """node, copies, first, vec, homes and visits of distinct vectors (node, copies, first, vec), each finite and not zero."""
    schema = "node long, copies long, first long, vec array<double>, homes array<long>, visits array<long>"

    def run(batches):
        lattices: dict[int, Lattice] = {}
        for batch in batches:
            for start in range(0, len(batch), 4096):
                piece = batch.slice(start, 4096)
                column = piece.column("vec")
                widths = np.array([len(x) for x in column])
                for width in np.unique(widths):
                    part = piece.filter(pa.array(widths == width))
                    vectors = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(part), width)
                    homes, visits = lattices.setdefault(int(width), Lattice(int(width))).cells(unit_rows(vectors))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "copies", "first", "vec")), pa.array(list(homes), pa.list_(pa.int64())), pa.array(list(visits), pa.list_(pa.int64()))], names=["node", "copies", "first", "vec", "homes", "visits"])

    return vectors.mapInArrow(run, schema)


def tiles(nodes: DataFrame) -> DataFrame:
    """width, place, cell, i, j, side, node: what meets where. Cells of several vectors are cut into blocks, each pair of blocks a tile."""
    of = F.size("vec").alias("width")
    at_home = nodes.select("node", of, F.posexplode("homes").alias("place", "cell"), F.lit(True).alias("home"))
    visiting = nodes.select("node", of, F.posexplode("visits").alias("place", "cell"), F.lit(False).alias("home")).withColumn("place", F.floor(F.col("place") / PROBES).cast("int"))
    members = at_home.unionByName(visiting)
    where = ["width", "place", "cell"]
    shared = members.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("long")).alias("h")).where("n > 1 and h > 0").select(*where, F.ceil(F.col("n") / TILE).alias("g"))
    block = F.pmod(F.xxhash64("node", "place", "home"), F.col("g")).cast("int")
    met = members.join(shared, where).withColumn("block", block)
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("g") - 1).cast("int"))))
    return spread.select(*where, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("second"), "home", "node")


def in_cells(cells: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """For each row whether its value is among its cells."""
    return (cells == cell[:, None]).any(1)


def counted(place: int, alone: bool, r: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions x and y of the linked pairs of a tile that are counted there.

    r has node, home, second, unit, homes and visits of the vectors that meet in a cell of table place; alone tells a block
    that meets itself. Of the cells in which a pair meets, the one in the first table counts; if there each visits the
    other's home, the home of the greater number.
    """
    homes, visits = r["homes"], r["visits"].reshape(len(r["node"]), TABLES, PROBES)
    left = np.arange(len(homes)) if alone else np.flatnonzero(~r["second"])
    right = left if alone else np.flatnonzero(r["second"])
    if not len(left) or not len(right) or any((homes[:, s] == homes[0, s]).all() for s in range(place)):  # all have met before
        return left[:0], left[:0]
    x, y = np.nonzero(r["unit"][left] @ r["unit"][right].T >= COSINE)
    x, y = left[x], right[y]
    ok = (r["home"][x] | r["home"][y]) & (r["node"][x] != r["node"][y])
    if alone:
        ok &= x < y
    x, y = x[ok], y[ok]
    for s in range(place):
        met = (homes[x, s] == homes[y, s]) | in_cells(visits[x, s], homes[y, s]) | in_cells(visits[y, s], homes[x, s])
        x, y = x[~met], y[~met]
    guest, host = np.where(r["home"][x], y, x), np.where(r["home"][x], x, y)
    both = r["home"][x] & r["home"][y]
    ok = both | ~in_cells(visits[host, place], homes[guest, place]) | (r["node"][guest] < r["node"][host])
    return x[ok], y[ok]


def least_of(size: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least position that each position is joined to by pairs (x, y)."""
    least = np.arange(size)
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if (least == before).all():
            return least


def found(met: DataFrame) -> DataFrame:
    """node, links (copies of the vectors linked to it in a tile) and root (the least node that it is joined to there)."""
    keys = ["width", "place", "cell", "i", "j"]

    def tile(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.sort_by("node").combine_chunks()
        width, place = rows["width"][0].as_py(), rows["place"][0].as_py()
        r = {c: rows[c].to_numpy() for c in ("node", "copies", "home", "second")}
        r |= {c: rows[c].combine_chunks().flatten().to_numpy().reshape(len(rows), -1) for c in ("homes", "visits")}
        r["unit"] = unit_rows(rows["vec"].combine_chunks().flatten().to_numpy().reshape(-1, width))
        x, y = counted(place, rows["i"][0] == rows["j"][0], r)
        if not len(x):
            return None
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, x, r["copies"][y])
        np.add.at(links, y, r["copies"][x])
        root = least_of(len(rows), x, y)
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(r["node"][some]), pa.array(links[some]), pa.array(r["node"][root[some]])], names=["node", "links", "root"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in keys]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if len(batch) else []
            bounds = [0, *changes, len(batch)]
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(c[start] for c in columns) if end > start else last
                if key != last and held:
                    if (out := tile(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                last = key
                held.append(batch.slice(start, end - start))
        if held and (out := tile(pa.Table.from_batches(held))) is not None:
            yield out

    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "node long, links long, root long")


def linked(rows: DataFrame) -> DataFrame:
    """vec_id, n_links and component_id of every row of rows (vec_id, vec array of doubles)."""
    usable = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    # Staged, so the numbers stay the same afterwards. Equal vectors are one node.
    single = rows.where(usable).groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    nodes = staged(located(single.select(F.monotonically_increasing_id().alias("node"), "copies", "first", "vec")), "vectors")
    met = staged(tiles(nodes), "meetings")
    links = staged(found(met.join(nodes.select("node", "copies", "vec", "homes", "visits"), "node")), "vector-links")
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(links.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = staged(nodes.select("node", "copies", "first").join(sums, "node", "left").join(whole, "node", "left"), "vector-classes")
    least = placed.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    named = placed.join(least, "component", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    by_vector = nodes.select("node", "vec").join(named, "node").select("vec", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.where(usable).join(by_vector, "vec", "left").select("vec_id", "n_links", "component_id").unionByName(alone)


def op11_vector_links(spark, sf_dir: str) -> DataFrame:
    """How many other vectors have a cosine of 0.95 or more with each, and the component that these links make.

    Null, empty and zero vectors and those that hold null or non-finite components link with nothing, as do vectors of
    different lengths with one another. Equal vectors are compared once and count as often as they come; rows repeated
    with one vec_id each count and each give a row. A row without vec_id counts as any other, but names no component: its
    component_id is the least vec_id of the others, or null, and it is kept where that is null. Vectors of any length are
    compared whole. An empty table gives no rows. Other columns are never read.
    """
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = linked(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: All pairs; exact, while the tables miss a pair now and then that is just above the bound.
ORACLE = """
    WITH RECURSIVE v AS (SELECT row_number() OVER () AS n, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    u AS (SELECT n, vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    l AS MATERIALIZED (SELECT a.n AS a, b.n AS b, b.vec_id AS other FROM u a JOIN u b ON a.n <> b.n AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    r AS (SELECT n AS a, n AS b FROM u UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
    c AS (SELECT a, min(vec_id) AS component_id FROM r JOIN v ON v.n = r.b GROUP BY a),
    k AS (SELECT a, count(*)::BIGINT AS n_links FROM l GROUP BY a)
    SELECT v.vec_id, coalesce(k.n_links, 0)::BIGINT AS n_links, CASE WHEN c.a IS NULL THEN v.vec_id ELSE c.component_id END AS component_id,
           v.vec_id IS NOT DISTINCT FROM CASE WHEN c.a IS NULL THEN v.vec_id ELSE c.component_id END AS kept
    FROM v LEFT JOIN c ON c.a = v.n LEFT JOIN k ON k.a = v.n"""
