"""Vector operators against brute force, with odd rows."""

import hashlib
import math

import numpy as np
import pytest

from seqloom.llm import filtering_lloyd as lloyd, lattice
from seqloom.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, vec string, component string, cell string"


def vectors():
    rng = np.random.default_rng(3)
    out = []
    base = rng.normal(size=(40, 16))
    for k in range(150):  # clusters of near copies, chains among them
        v = base[k % 40] + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.2])
        out.append([1000 - k, (v / np.linalg.norm(v)).tolist(), k % 3 if k % 5 else None])
    out += [[k, out[7][1], 1] for k in (2000, 2001, 5)] + [[2002, [3 * x for x in out[8][1]], 1]]  # equal and scaled ones
    nan, inf = float("nan"), float("inf")
    out += [[3000, None, 1], [3001, [0.0] * 16, 1], [3002, [nan] + [1.0] * 15, 1], [3003, [inf] + [1.0] * 15, None], [3004, [None] + [1.0] * 15, 2], [3005, [], 2], [3006, [1.0, 2.0], 2]]
    out += [[None, out[9][1], 2], out[3], out[3]]  # without id; a row repeated
    out += [[4000, [1e30] * 16, 9], [4001, [-1e30] * 16, 9], [4002, [1e-30] * 16, 9]]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vectors")
    frame = spark.createDataFrame([(*r, 7, "x", "x", "x") for r in vectors()], SCHEMA)
    frame.repartition(5).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def single(x):
    """A component as the table holds it."""
    return None if x is None else float(np.float32(x))


def plain_links(rows):
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    near = lambda a, b: len(a) == len(b) and sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b)) >= 0.95
    links = {i: [j for j in range(len(rows)) if j != i and good[i] and good[j] and near(rows[i][1], rows[j][1])] for i in range(len(rows))}
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen |= set(new)
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), least, key == least))
    return out


def test_links_equal_brute_force(spark, folder):
    rows = [(k, None if v is None else [single(x) for x in v], y) for k, v, y in vectors()]
    got = [tuple(r) for r in QUERIES["op11_vector_links"](spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(plain_links(rows), key=repr)


def test_blocks_of_a_cell_count_each_pair_once(spark, folder, monkeypatch):
    whole = sorted((tuple(r) for r in QUERIES["op11_vector_links"](spark, folder).collect()), key=repr)
    monkeypatch.setattr(lattice, "TILE", 3)
    assert sorted((tuple(r) for r in QUERIES["op11_vector_links"](spark, folder).collect()), key=repr) == whole


def test_recall_just_above_the_bound():
    """Pairs of a cosine of 0.95 exactly, the hardest that count, in few and in many dimensions."""
    rng = np.random.default_rng(8)
    for width in (4, 16, 64, 300):
        u, w = rng.normal(size=(2, 1500, width))
        u /= np.linalg.norm(u, axis=1)[:, None]
        w -= (w * u).sum(1)[:, None] * u
        v = 0.9501 * u + math.sqrt(1 - 0.9501**2) * w / np.linalg.norm(w, axis=1)[:, None]
        grid = lattice.Lattice(width)
        (a, p), (b, q) = grid.cells(u), grid.cells(v)
        p, q = p.reshape(len(p), lattice.TABLES, -1), q.reshape(len(q), lattice.TABLES, -1)
        met = (a == b) | (p == b[:, :, None]).any(2) | (q == a[:, :, None]).any(2)
        assert met.any(1).mean() >= 0.97, width


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) * 2
    near = lattice.decode(x)
    gaps = ((x[:, None] - (near[:, None] + lattice.roots()[None])) ** 2).sum(2).min(1)
    assert (((x - near) ** 2).sum(1) <= gaps + 1e-12).all() and ((2 * near) % 1 == 0).all()
    assert len(lattice.roots()) == 240


def plain_codes(rows):
    def ok(v):
        return v is not None and len(v) > 0 and len(v) % 8 == 0 and all(x is not None and math.isfinite(x) for x in v)

    kept = [(k, y, [max(-(1 << 62), min(1 << 62, math.floor(4096 * x))) for x in v], v) for k, v, y in rows if ok(v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[3]))
    kept = [r for r in kept if len(r[2]) == len(first[0][2])]
    size = len(kept[0][2]) // 8
    cut = lambda q, p: q[p * size : (p + 1) * size]
    books = [[list(cut(r[2], p)) for r in first[:16]] for p in range(8)]

    def nearest(book, v):
        return min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v, book[e])), e))

    for _ in range(6):
        for p in range(8):
            groups = {}
            for r in kept:
                groups.setdefault(nearest(books[p], cut(r[2], p)), []).append(cut(r[2], p))
            for e, parts in groups.items():
                books[p][e] = [sum(x) // len(parts) for x in zip(*parts)]
    out, sums = [], {}
    for k, y, q, _ in kept:
        codes = [nearest(books[p], cut(q, p)) for p in range(8)]
        error = min((1 << 63) - 1, sum(sum((a - b) ** 2 for a, b in zip(cut(q, p), books[p][e])) for p, e in enumerate(codes)))
        sums[y] = sums.get(y, 0) + error
        out.append([k, "".join(f"{e:02x}" for e in codes), error, y])
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(k, c, e, min((1 << 63) - 1, sums[y]), sha) for k, c, e, y in out]


def test_codes_equal_brute_force(spark, folder, monkeypatch):
    rows = [(k, None if v is None else [single(x) for x in v], y) for k, v, y in vectors()]
    want = sorted(plain_codes(rows), key=repr)
    assert sorted((tuple(r) for r in QUERIES["op12_vector_codes"](spark, folder).collect()), key=repr) == want
    monkeypatch.setattr(lloyd, "BROADCAST_LABELS", 0)
    assert sorted((tuple(r) for r in QUERIES["op12_vector_codes"](spark, folder).collect()), key=repr) == want


def test_a_walk_assigns_every_point_to_the_lowest_nearest_entry():
    rng = np.random.default_rng(6)
    for n, top in ((1, 5), (33, 2), (700, 3), (3000, 4000)):
        points, book = rng.integers(-top, top + 1, (n, 8)), rng.integers(-top, top + 1, (16, 8))
        book[9] = book[2]  # entries that tie
        far = ((points[:, None] - book[None]) ** 2).sum(2)
        tree = lloyd.Tree.built(points)
        codes, error = lloyd.assigned(tree, book)
        assert (codes == far.argmin(1)).all() and (error == far.min(1)).all()
        sums, counts = lloyd.summed(tree, book)
        assert all((sums[e] == points[codes == e].sum(0)).all() for e in range(16)) and (counts == np.bincount(codes, minlength=16)).all()


def test_most_subtrees_are_assigned_whole():
    rng = np.random.default_rng(7)
    centres = rng.integers(-4000, 4000, (16, 8))
    tree = lloyd.Tree.built(np.repeat(centres, 500, axis=0) + rng.integers(-40, 40, (8000, 8)))
    singles = []
    lloyd.walk(tree, centres, lambda *_: None, lambda at, _: singles.append(len(at)))
    assert sum(singles) < 800


@pytest.mark.parametrize("name", ["op11_vector_links", "op12_vector_codes"])
def test_no_rows(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    frame = QUERIES[name](spark, str(tmp_path))
    assert frame.collect() == [] and "vec_id" in frame.columns
    spark.createDataFrame([(1, None, 1, 1, "", "", "")], SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (name == "op11_vector_links")
