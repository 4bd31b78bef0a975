"""K-mers of gene families as text: document frequencies, TF-IDF weights, neighbour graphs and clusters."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import sequences
from ..sources.staging import staged


#: K-mers that a task holds before it hands their counts on.
HELD = 2_000_000


def packed_kmers(seq: str, k: int) -> np.ndarray:
    """The distinct k-mers of an ASCII text, each as a number whose bytes are its letters; k is 8 at most."""
    letters = np.frombuffer(seq.encode("ascii"), np.uint8).astype(np.uint64)
    n = len(letters) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out << np.uint64(8)) | letters[i : i + n]
    return np.unique(out)


def kmer_document_frequency(records: DataFrame, k: int = 5) -> DataFrame:
    """og, kmer and in how many records of the family it is.

    Each task counts what it has read, so a family's k-mers leave it once for every HELD of them and not once a record.
    Longer k-mers than of eight letters, and texts of other letters than ASCII, are counted record by record.
    """
    rows = records.where("seq is not null").select("og", "seq")
    small = F.lit(k <= 8) & ~F.col("seq").rlike(r"[^\x00-\x7F]|\n")
    plain = rows.where(~small).select("og", F.explode(F.array_distinct(sequences.kmers(F.col("seq"), k))).alias("kmer"), F.lit(1).cast("long").alias("n"))

    def run(batches):
        held: dict = {}
        kind, size = None, 0

        def counts():
            for og, parts in held.items():
                kmers, n = np.unique(np.concatenate(parts), return_counts=True)
                letters = np.ascontiguousarray(kmers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - k :]).view(f"S{k}").ravel()
                yield pa.RecordBatch.from_arrays([pa.array([og], kind).take(pa.array(np.zeros(len(n), np.int64))), pa.array(letters.astype(object), pa.binary()).cast(pa.string()), pa.array(n)], names=["og", "kmer", "n"])

        for batch in batches:
            kind = batch.schema.field("og").type
            for og, seq in zip(batch.column("og").to_pylist(), batch.column("seq"), strict=True):
                found = packed_kmers(seq.as_py(), k)
                held.setdefault(og, []).append(found)
                size += len(found)
                if size >= HELD:
                    yield from counts()
                    held, size = {}, 0
        yield from counts()

    counted = rows.where(small).mapInArrow(run, f"og {dict(rows.dtypes)['og']}, kmer string, n long") if k <= 8 else rows.where("false").selectExpr("og", "'' AS kmer", "0L AS n")
    return counted.unionByName(plain).groupBy("og", "kmer").agg(F.sum("n").alias("df"))


def tfidf_vectors(records: DataFrame, k: int = 5, longest: int = 1, least_df: int = 5) -> tuple[DataFrame, DataFrame]:
    """og, id, rep of all records; og, rep, terms (an array of term and weight) of those that have a term.

    Weights as in tfidf. Records of one family with the same texts have one vector, that of their least id (rep), so the
    work on terms is that of the distinct texts.
    """
    owned = records.where("og is not null and id is not null").groupBy("og", "id").agg(F.sort_array(F.collect_list("seq")).alias("_seqs"))
    texts = staged(owned.groupBy("og", "_seqs").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("_copies")), "kmer-texts")
    words = sequences.kmers(F.col("_seq"), k)

    def runs(n: int):
        return F.transform(F.sequence(F.lit(0), F.size("_words") - n), lambda i: F.array_join(F.slice("_words", i + 1, n), " "))

    grams = F.concat(*(F.when(F.size("_words") >= n, g).otherwise(F.array().cast("array<string>")) for n, g in enumerate((F.col("_words"), *(runs(n) for n in range(2, longest + 1))), 1)))
    cut = texts.select("og", "rep", "_copies", F.explode("_seqs").alias("_seq")).withColumn("_words", words)
    tf = staged(cut.select("og", "rep", "_copies", F.explode(grams).alias("term")).groupBy("og", "rep", "_copies", "term").agg(F.count(F.lit(1)).alias("tf")), "kmer-terms")
    sizes = texts.groupBy("og").agg(F.sum("_copies").alias("n"))
    df = tf.groupBy("og", "term").agg(F.sum("_copies").alias("df")).where(F.col("df") >= least_df).join(sizes, "og")
    raw = tf.join(df.select("og", "term", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf")), ["og", "term"]).withColumn("raw", F.col("tf") * F.col("idf"))
    lists = raw.groupBy("og", "rep").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_norm"), F.collect_list(F.struct("term", "raw")).alias("_raw"))
    norm = F.col("_norm")
    vectors = lists.select("og", "rep", F.transform("_raw", lambda t: F.struct(t["term"].alias("term"), (t["raw"] / norm).alias("weight"))).alias("terms"))
    return owned.join(texts, ["og", "_seqs"]).select("og", "id", "rep"), staged(vectors, "kmer-vectors")


def tfidf(records: DataFrame, k: int = 5, longest: int = 1, least_df: int = 5) -> DataFrame:
    """og, id, term, weight: smoothed TF-IDF of runs of 1 to `longest` k-mers, of length one for each record.

    Terms of fewer than least_df records of the family are left out.
    """
    members, vectors = tfidf_vectors(records, k, longest, least_df)
    return members.join(vectors, ["og", "rep"]).select("og", "id", F.inline("terms"))


#: Points of a block; two blocks of a group at a time are compared in one task.
BLOCK = 1024
#: Distances are compared to within this share of the squared lengths before they are worked out term by term.
NEAR = 1e-9


def _nearest(x: np.ndarray, y: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x, rows of y and squared distances of the k nearest of y to each of x within most (squared), and of those that tie with them."""
    if not len(x) or not len(y):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    a, b = (x * x).sum(1), (y * y).sum(1)
    rough = a[:, None] + b[None] - 2 * x @ y.T
    slack = NEAR * (a[:, None] + b.max())
    last = np.partition(rough, min(k, len(y)) - 1, 1)[:, min(k, len(y)) - 1, None]
    rows, others = np.nonzero((rough <= last + slack) & (rough <= most[:, None] + slack))
    exact = np.zeros(len(rows))
    for c in range(x.shape[1]):  # in the order of the components, as a sum over a row has it
        d = x[rows, c] - y[others, c]
        exact += d * d
    return rows, others, exact


def _tiles(rows: DataFrame, group: str, k: int) -> DataFrame:
    """group, id, other, d2: the nearest others of each point of a tile of two blocks, k for each point or a few more that tie."""
    keys = [group, "_i", "_j"]
    kinds = dict(rows.dtypes)

    def tile(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own, other in ((0, 1), (1, 0)) if key[1] != key[2] else ((0, 0),):
            x, y = pdf[pdf["_side"] == own], pdf[pdf["_side"] == other]
            if not len(x) or not len(y):
                continue
            p, q = (np.array(v["vec"].tolist(), float).reshape(len(v), -1) for v in (x, y))
            at, to, d2 = _nearest(p, q, x["_most"].to_numpy(float), k + (own == other))
            found = pd.DataFrame({"id": x["id"].to_numpy()[at], "other": y["id"].to_numpy()[to], "d2": d2})
            found = found[found["id"] != found["other"]]
            best = found.sort_values(["id", "d2", "other"]).groupby("id", sort=False).head(k)
            out.append(best.assign(**{group: key[0]})[[group, "id", "other", "d2"]])
        return pd.concat(out) if out else pd.DataFrame({group: [], "id": [], "other": [], "d2": []})

    return rows.groupBy(*keys).applyInPandas(tile, f"{group} {kinds[group]}, id {kinds['id']}, other {kinds['id']}, d2 double")


def knn_edges(points: DataFrame, k: int = 10, group: str = "label") -> DataFrame:
    """group, id, other, place, d2: the k nearest other points of a group by Euclidean distance (d2, squared), ties by id.

    Groups of at most k points have no edges. A group is cut into blocks of about BLOCK points in the order of their
    distance to the group's least point. Each block is compared with itself first, which bounds how far the nearest of
    its points can be; then with the blocks that are near enough by that order to hold a nearer one. A pair of blocks is
    one task's work and gives k rows a point, so a large group is the work of many tasks, and no pair of points a row.
    """
    own = points.where(F.col(group).isNotNull()).select(group, "id", "vec")
    sizes = own.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.min_by("vec", "id").alias("_from")).where(F.col("_n") > k)
    far = F.sqrt(F.aggregate(F.zip_with("vec", "_from", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    placed = staged(own.join(sizes, group).select(group, "id", "vec", "_n", far.alias("_far")), "knn-points")
    # The distances at which blocks end: quantiles, so a block has about as many points as another.
    ends = placed.groupBy(group).agg(F.max("_n").alias("_n"), F.percentile_approx("_far", F.array(*(F.lit((c + 1) / 64) for c in range(63))), F.lit(10_000)).alias("_ends"))
    rings = F.least(F.lit(64), F.ceil(F.col("_n") / BLOCK))
    coarse = F.floor(F.size(F.filter("_ends", lambda e: e < F.col("_far"))) * rings / 64)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_n") / (64 * BLOCK)).cast("int"))
    cut = placed.drop("_n").join(ends, group).withColumn("_block", F.when(F.col("_n") <= BLOCK, 0).otherwise(coarse * blocks + F.pmod(F.xxhash64("id"), blocks)).cast("int"))
    cut = staged(cut.select(group, "id", "vec", "_far", "_block"), "knn-blocks")
    alone = cut.select(group, F.col("_block").alias("_i"), F.col("_block").alias("_j"), "id", "vec", F.lit(0).alias("_side"), F.lit(float("inf")).alias("_most"))
    first = staged(_tiles(alone, group, k), "knn-own")
    bound = first.groupBy(group, "id").agg(F.when(F.count(F.lit(1)) >= k, F.max("d2")).alias("_most"))
    known = staged(cut.join(bound, [group, "id"], "left").withColumn("_most", F.coalesce("_most", F.lit(float("inf")))), "knn-bounds")
    # What two blocks need at least: how far apart their distances to the least point are. One row a block.
    shape = known.groupBy(group, "_block").agg(F.min("_far").alias("lo"), F.max("_far").alias("hi"), F.max("_most").alias("most"))
    a, b = (shape.select(group, *(F.col(c).alias(f"{c}_{side}") for c in ("_block", "lo", "hi", "most"))) for side in "ab")
    gap = F.greatest(F.lit(0.0), F.col("lo_a") - F.col("hi_b"), F.col("lo_b") - F.col("hi_a"))
    near = a.join(b, group).where((F.col("_block_a") < F.col("_block_b")) & (gap * gap * (1 - NEAR) <= F.greatest("most_a", "most_b"))).select(group, F.col("_block_a").alias("_i"), F.col("_block_b").alias("_j"))
    sides = near.select(group, F.col("_i").alias("_block"), "_i", "_j", F.lit(0).alias("_side")).unionByName(near.select(group, F.col("_j").alias("_block"), "_i", "_j", F.lit(1).alias("_side")))
    others = _tiles(known.join(sides, [group, "_block"]).select(group, "_i", "_j", "id", "vec", "_side", "_most"), group, k)
    every = first.unionByName(others)
    order = Window.partitionBy(group, "id").orderBy("d2", "other")
    return every.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select(group, "id", "other", "place", "d2")


#: Vectors of a block; two blocks of a family at a time meet in one task.
VECTORS = 4096


def _nearest_vectors(x: pa.Table, y: pa.Table, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x, rows of y, products and squared distances of the nearest of y to each of x, ties in the order of y."""
    def parts(t: pa.Table):
        lists = t["terms"].combine_chunks()
        return np.array(lists.offsets), lists.values.field("term"), lists.values.field("weight").to_numpy()

    (xo, xt, xw), (yo, yt, yw) = parts(x), parts(y)
    coded = pa.concat_arrays([xt, yt]).dictionary_encode()
    codes = coded.indices.to_numpy()
    xc, yc = codes[: len(xt)], codes[len(xt) :]
    order = np.argsort(yc, kind="stable")
    rows, weights = np.repeat(np.arange(len(y)), np.diff(yo))[order], yw[order]
    ends = np.searchsorted(yc[order], np.arange(len(coded.dictionary) + 1))
    has_x, has_y = ((np.diff(o) > 0).astype(float) for o in (xo, yo))
    out = []
    for i, (begin, end) in enumerate(zip(xo[:-1], xo[1:], strict=True)):
        dot = np.zeros(len(y))
        spans = [(ends[c], ends[c + 1], w) for c, w in zip(xc[begin:end], xw[begin:end], strict=True) if ends[c] < ends[c + 1]]
        if spans:
            dot = np.bincount(np.concatenate([rows[b:e] for b, e, _ in spans]), np.concatenate([weights[b:e] * w for b, e, w in spans]), len(y))
        d2 = np.maximum(0.0, has_x[i] + has_y - 2.0 * dot)
        near = np.flatnonzero(d2 <= np.partition(d2, most - 1)[most - 1] + 2e-9) if len(y) > most else np.arange(len(y))
        near = near[np.argsort(np.round(d2[near], 9), kind="stable")[:most]]
        out.append((np.full(len(near), i), near, dot[near], d2[near]))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def nearest_records(members: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """og, id, other, dot, d2, place: the nearest records of a family by vectors of length one, or zero without a term.

    members: og, id, rep; vectors: og, rep, terms as tfidf_vectors has them. Vectors of one rep are compared once. Each two
    blocks of a family are a key of their own and give k + 1 rows a vector, so no task has a family's pairs and no pair
    that isn't among the nearest is a row. Ties by the id of the other.
    """
    members = staged(members.select("og", "id", "rep"), "knn-members")
    terms = F.coalesce("terms", F.array().cast(dict(vectors.dtypes)["terms"])).alias("terms")
    every = members.select("og", "rep").distinct().join(vectors, ["og", "rep"], "left").select("og", "rep", terms)
    sizes = every.groupBy("og").agg(F.ceil(F.count(F.lit(1)) / VECTORS).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    dealt = every.join(sizes, "og").withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keys = ["og", "_lo", "_hi"]
    tasks = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), members.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt.select("og", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_own", "rep", "terms").repartition(tasks, *keys)
    kinds = dict(members.dtypes)

    def tile(key: tuple, table: pa.Table) -> pa.Table:
        og, lo, hi = key
        table = table.sort_by("rep")
        blocks = [table.filter(pc.equal(table["_own"], b)).combine_chunks() for b in (lo, hi)]
        found = []
        for x, y in ((blocks[0], blocks[1]), (blocks[1], blocks[0])) if lo != hi else (blocks,):
            if not len(x) or not len(y):
                continue
            i, j, dot, d2 = _nearest_vectors(x, y, k + 1)
            found.append(pa.table({"og": pa.repeat(og, len(i)), "rep": x["rep"].take(pa.array(i)), "near": y["rep"].take(pa.array(j)), "dot": dot, "d2": d2}))
        return pa.concat_tables(found) if found else pa.table({"og": pa.array([], og.type), "rep": table["rep"][:0], "near": table["rep"][:0], "dot": pa.array([], pa.float64()), "d2": pa.array([], pa.float64())})

    found = dealt.groupBy(*keys).applyInArrow(tile, f"og {kinds['og']}, rep {kinds['rep']}, near {kinds['rep']}, dot double, d2 double")
    by = Window.partitionBy("og", "rep").orderBy(F.round("d2", 9), "near")
    texts = found.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k + 1).drop("_n")
    # The least ids of a vector are all that can be among the nearest k, besides the record itself.
    ids = members.withColumn("_n", F.row_number().over(Window.partitionBy("og", "rep").orderBy("id"))).where(F.col("_n") <= k + 1)
    others = texts.join(ids.select("og", F.col("rep").alias("near"), F.col("id").alias("other")), ["og", "near"])
    first = Window.partitionBy("og", "rep").orderBy(F.round("d2", 9), "other")
    lists = others.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1).groupBy("og", "rep").agg(F.sort_array(F.collect_list(F.struct("_n", "other", "dot", "d2"))).alias("_near"))
    kept = F.slice(F.filter("_near", lambda o: o["other"] != F.col("id")), 1, k)
    rows = members.join(lists, ["og", "rep"]).select("og", "id", F.posexplode(kept).alias("_at", "o"))
    return rows.select("og", "id", "o.other", "o.dot", "o.d2", (F.col("_at") + 1).alias("place"))


def text_neighbours(weights: DataFrame, members: DataFrame, k: int = 10) -> DataFrame:
    """og, id, other, dot, d2, place: the nearest records of a family by TF-IDF rows, whose length is one, or zero without a term.

    Those that share no term follow by their distance (d2, squared), in order of id, to fill up k. members: og, id of all
    records. Records with equal rows are compared once.
    """
    rows = weights.groupBy("og", "id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    every = members.select("og", "id").distinct().join(rows, ["og", "id"], "left")
    texts = staged(every.groupBy("og", "terms").agg(F.min("id").alias("rep")), "knn-texts")
    known = every.join(texts, (every["og"] == texts["og"]) & every["terms"].eqNullSafe(texts["terms"])).select(every["og"], "id", "rep")
    return nearest_records(known, texts.where("terms is not null").select("og", "rep", "terms"), k)


def ward(rows: np.ndarray, threshold: float) -> np.ndarray:
    """Labels of clusters merged while the Ward distance is below the threshold (Lance and Williams' update)."""
    n = len(rows)
    d = np.array([np.sqrt(((rows - row) ** 2).sum(-1)) for row in rows]).reshape(n, n)
    np.fill_diagonal(d, np.inf)
    size, label, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    while alive.sum() > 1:
        i, j = np.unravel_index(int(d.argmin()), d.shape)
        i, j = min(i, j), max(i, j)
        if not d[i, j] < threshold:
            break
        for m in np.flatnonzero(alive):
            if m not in (i, j):
                total = size[i] + size[j] + size[m]
                d[i, m] = d[m, i] = np.sqrt(max(0.0, ((size[i] + size[m]) * d[i, m] ** 2 + (size[j] + size[m]) * d[j, m] ** 2 - size[m] * d[i, j] ** 2) / total))
        size[i] += size[j]
        alive[j] = False
        d[j, :] = d[:, j] = np.inf
        label[label == j] = i
    return label


def ward_of_graph(n: int, links: set[tuple[int, int]], threshold: float) -> list[int] | None:
    """The labels that ward gives rows of zeros and ones, in whole numbers and without a matrix; links are the places (row, column) of the ones.

    Of rows that have at least threshold^2 ones each, clusters without a common column are never nearer than the
    threshold, so only those with one are compared. None if some row has fewer ones. A cluster is its size and its sums
    by column; its nearest later cluster is worked out again once either has changed.
    """
    sums: list[dict[int, int] | None] = [{} for _ in range(n)]
    for row, column in links:
        sums[row][column] = 1
    limit = threshold * threshold
    if any(len(own) < limit for own in sums):
        return None
    having: dict[int, dict[int, int]] = {}
    for row, column in links:
        having.setdefault(column, {})[row] = 1
    size, squares, label = [1] * n, [len(own) for own in sums], list(range(n))

    def near(i: int) -> dict[int, float]:
        common: dict[int, int] = {}
        for column, own in sums[i].items():
            for j, other in having[column].items():
                common[j] = common.get(j, 0) + own * other
        common.pop(i, None)
        p = size[i]
        return {j: 2 * (size[j] ** 2 * squares[i] + p * p * squares[j] - 2 * p * size[j] * x) / (p * size[j] * (p + size[j])) for j, x in common.items()}

    def nearest(i: int, found: dict[int, float]) -> tuple[float, int, int, int, int] | None:
        d, j = min(((d, j) for j, d in found.items() if j > i and d < limit), default=(None, None))
        return None if j is None else (d, i, j, size[i], size[j])

    best = [nearest(i, near(i)) for i in range(n)]
    heap = [b for b in best if b]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        _, i, j, p, q = top
        if sums[i] is None or best[i] != top:
            continue
        if sums[j] is None or size[j] != q or size[i] != p:
            best[i] = nearest(i, near(i))
            if best[i]:
                heapq.heappush(heap, best[i])
            continue
        for column, x in sums[j].items():
            del having[column][j]
            sums[i][column] = having[column][i] = sums[i].get(column, 0) + x
        sums[j] = best[j] = None
        size[i] += q
        squares[i] = sum(x * x for x in sums[i].values())
        label[j] = i
        found = near(i)
        best[i] = nearest(i, found)
        if best[i]:
            heapq.heappush(heap, best[i])
        for k, d in found.items():
            if k < i and d < limit and (best[k] is None or (d, i) < (best[k][0], best[k][2])):
                best[k] = (d, k, i, size[k], size[i])
                heapq.heappush(heap, best[k])
    for i in range(n):  # a label is never above its row, and smaller ones are final
        label[i] = label[label[i]]
    return label


def clusters_of_graph(edges: DataFrame, members: DataFrame, threshold: float = 3.0, group: str = "og") -> DataFrame:
    """group, id, cluster: agglomerative clusters of the rows of each family's neighbour matrix. A family is one task's work.

    Equal distances are merged in the order of ids. A family of few neighbours for the threshold takes a matrix of
    its members; with k neighbours each and k at least threshold^2 a task holds the links only.
    """

    def one(key, own, links):
        ids = sorted(own["id"].tolist())
        place = {x: k for k, x in enumerate(ids)}
        ones = {(place[a], place[b]) for a, b in zip(links["id"], links["other"], strict=True)}
        names = ward_of_graph(len(ids), ones, threshold)
        if names is None:
            matrix = np.zeros((len(ids), len(ids)))
            for a, b in ones:
                matrix[a, b] = 1
            names = ward(matrix, threshold)
        return pd.DataFrame({group: [key[0]] * len(ids), "id": ids, "cluster": [ids[k] for k in names]})

    kinds = dict(members.dtypes)
    schema = f"{group} {kinds[group]}, id {kinds['id']}, cluster {kinds['id']}"
    own = members.select(F.col(group).alias(group), F.col("id").alias("id"))
    links = edges.select(F.col(group).alias(group), F.col("id").alias("id"), "other")
    return own.groupBy(group).cogroup(links.groupBy(group)).applyInPandas(one, schema)


def cluster_votes(members: DataFrame, threshold: float = 0.6, levels=("domain", "supergroup", "major", "minor")) -> DataFrame:
    """cluster, level, label, votes, total: labels that more than the threshold's share of a cluster's members have, at each level."""
    long = members.select("cluster", F.explode(F.array(*(F.struct(F.lit(x).alias("level"), F.col(x).alias("label")) for x in levels))).alias("v")).select("cluster", "v.*")
    votes = long.groupBy("cluster", "level", "label").agg(F.count(F.lit(1)).alias("votes"))
    total = F.sum("votes").over(Window.partitionBy("cluster", "level"))
    return votes.withColumn("total", total).where(F.col("votes") > F.col("total") * threshold)


#: Other members of a cluster that a query meets in one task, about.
MET = 1 << 10


def by_catch(members: DataFrame, query_taxon: str, threshold: float = 0.6, levels=("domain", "supergroup", "major", "minor")) -> DataFrame:
    """Rows (query, labels of the other member, other member) of clusters with both the query taxon and others.

    Only members of the supergroup that wins the cluster's vote among the others come up, so a cluster without one gives
    no row. Major and minor keep their labels only if some label of that level wins its vote.

    The rows grow with the square of a cluster. The others are dealt to blocks of about MET, which meet the queries one
    by one, so a large cluster is the work of many tasks and none holds more than a block.
    """
    asked = F.contains("id", F.lit(query_taxon))
    queries = members.where(asked).select("cluster", F.col("id").alias("query_seq"))
    others = members.where(~asked).dropDuplicates(["cluster", "id"])
    votes = cluster_votes(others, threshold, levels)
    winners = votes.where("level = 'supergroup'").select("cluster", F.col("label").alias("supergroup"))
    clear = votes.groupBy("cluster").agg(*(F.bool_or(F.col("level") == x).alias(f"_{x}") for x in ("major", "minor")))
    label = {x: F.when(F.col(f"_{x}"), F.col(x)).otherwise(f"No-clear-{x}-clade") for x in ("major", "minor")}
    found = others.join(winners, ["cluster", "supergroup"]).join(clear, "cluster")
    found = found.select("cluster", *(label.get(x, F.col(x)).alias(x) for x in levels), F.col("id").alias("cluster_seq"), F.split_part("id", F.lit("|"), F.lit(1)).alias("cluster_taxon"))
    found = staged(found, "by-catch-members")
    sizes = found.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / MET).cast("int").alias("_blocks"))
    tasks = sizes.agg(F.least(F.coalesce(F.sum("_blocks"), F.lit(1)), F.lit(10_000))).first()[0]
    found = found.join(sizes, "cluster").withColumn("_block", F.pmod(F.xxhash64("cluster_seq"), F.col("_blocks")).cast("int")).drop("_blocks")
    queries = queries.join(sizes, "cluster").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    # A stated number of tasks, as what goes in is little beside what comes out.
    rows = queries.repartition(tasks, "cluster", "_block").join(found.repartition(tasks, "cluster", "_block"), ["cluster", "_block"])
    return rows.select("query_seq", *levels, "cluster_seq", "cluster_taxon")
