"""Outliers inside gene families: by length, by distance to the others, by local density."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged
from .text_mining import knn_edges


def sized_families(records: DataFrame, length, low: float = 0.33, high: float = 2.0, centre: str = "median", least: int = 4) -> DataFrame:
    """size_filter() by a column of lengths."""
    middle = F.percentile(length, F.lit(0.5)) if centre == "median" else F.avg(length)
    families = records.groupBy("og").agg(middle.alias("_mid"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    kept = records.join(families, "og").where((length >= F.col("_mid") * low) & (length <= F.col("_mid") * high)).drop("_mid", "_n")
    left = kept.groupBy("og").agg(F.count(F.lit(1)).alias("_left")).where(F.col("_left") >= least).select("og")
    return kept.join(left, "og", "left_semi")


def size_filter(records: DataFrame, low: float = 0.33, high: float = 2.0, centre: str = "median", least: int = 4) -> DataFrame:
    """Records near their family's median or mean length; families with fewer than `least` records before or after go."""
    return sized_families(records, F.length("seq"), low, high, centre, least)


#: Texts of a family are dealt to blocks of about so many; two blocks at a time meet in one task. Where pairs aren't rows, blocks are WIDER times as large.
BLOCK = 512
WIDER = 8
#: Pairs of texts whose distances are worked out at once.
AT_ONCE = 1 << 15


def edit_distances(x: list[str], y: list[str]) -> np.ndarray:
    """Edit distance of each text of x to each of y, by code points: columns of differences as bits (Myers 1999), for all pairs side by side."""
    points = [np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (*x, *y)]
    letters = np.unique(np.concatenate(points)) if points else np.zeros(0, np.uint32)
    codes = [np.searchsorted(letters, p) for p in points]
    # Long texts first, so those that still have letters are the first ones at every column.
    xs, ys = (sorted(range(len(t)), key=lambda i, t=t: -len(t[i])) for t in (codes[: len(x)], codes[len(x) :]))
    lengths = np.array([len(codes[len(x) + j]) for j in ys], np.int64)
    columns = np.zeros((int(lengths.max(initial=0)), len(y)), np.int64)
    for at, j in enumerate(ys):
        columns[: lengths[at], at] = codes[len(x) + j]
    going = [int((lengths > c).sum()) for c in range(len(columns))]
    out = np.zeros((len(x), len(y)), np.int32)
    step = max(1, AT_ONCE // max(1, len(y)))
    for begin in range(0, len(xs), step):
        mine = xs[begin : begin + step]
        longest = len(codes[mine[0]])
        kind, bits = (np.uint32, 32) if longest <= 32 else (np.uint64, 64)
        words = -(-longest // bits)
        one, top = kind(1), kind(bits - 1)
        where = np.zeros((words, len(mine), len(letters)), kind)
        own = np.zeros((words, len(mine), 1), kind)  # the bits that a text of x has
        for at, i in enumerate(mine):
            for k, c in enumerate(codes[i]):
                where[k // bits, at, c] |= one << kind(k % bits)
                own[k // bits, at, 0] |= one << kind(k % bits)
        more, less = np.full((words, len(mine), len(y)), ~kind(0)), np.zeros((words, len(mine), len(y)), kind)
        for c, n in enumerate(going):
            up, down = one, kind(0)  # the first row goes up by one in each column
            for w in range(words):
                p, m = more[w, :, :n], less[w, :, :n]
                same = np.take(where[w], columns[c, :n], axis=1)
                vertical = same | m
                if w:
                    same |= down
                across = same & p
                across += p
                across ^= p
                across |= same
                plus = across | p
                np.invert(plus, out=plus)
                plus |= m
                across &= p
                following = (plus >> top, across >> top) if w + 1 < words else None
                plus <<= one
                plus |= up
                across <<= one
                if w:
                    across |= down
                np.bitwise_and(plus, vertical, out=m)
                plus |= vertical
                np.invert(plus, out=plus)
                np.bitwise_or(across, plus, out=p)
                if following:
                    up, down = following
        found = lengths[None] + sum(np.bitwise_count(more[w] & own[w]).astype(np.int64) - np.bitwise_count(less[w] & own[w]) for w in range(words))
        out[np.array(mine)[:, None], np.array(ys, int)[None]] = found
    return out


def text_tiles(texts: DataFrame, size: int, f: Callable, schema: str) -> DataFrame:
    """What f(og, x, y, d) makes of each two blocks of a family: Arrow tables x and y of texts and the matrix of their edit distances.

    texts: og, seq and other columns, a row for each distinct text; those without a family or a sequence go. A block with
    itself is one table twice. Each pair of blocks of a family is a key of its own, so a large family is the work of many
    tasks; a text goes to as many keys as its family has blocks of that size.
    """
    texts = texts.where("og is not null and seq is not null")
    sizes = texts.groupBy("og").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_blocks"))
    block = F.pmod(F.xxhash64("seq"), F.col("_blocks")).cast("int")
    rows = texts.join(sizes, "og").withColumn("_own", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"_lo": F.least("_own", "_other"), "_hi": F.greatest("_own", "_other")})
    # Few bytes and much work: dealt by pair of blocks to a stated number of tasks, which adaptive execution leaves apart.
    keys = ["og", "_lo", "_hi"]
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), texts.sparkSession.sparkContext.defaultParallelism)
    rows = rows.select(*texts.columns, "_own", "_lo", "_hi").repartition(tasks, *keys)

    def tile(key: tuple, table: pa.Table) -> pa.Table:
        og, lo, hi = key
        x = table.filter(pc.equal(table["_own"], lo))
        y = table.filter(pc.equal(table["_own"], hi)) if lo != hi else x
        return f(og, x, y, edit_distances(x["seq"].to_pylist(), y["seq"].to_pylist()))

    return rows.groupBy(*keys).applyInArrow(tile, schema)


def distances(records: DataFrame) -> DataFrame:
    """og, a, b, d: edit distance of each two distinct texts of a family (a < b by text).

    Equal sequences are one text here: the distances of records are those of their texts, so a family with many copies
    costs what its distinct texts cost.
    """
    kind = dict(records.dtypes)["og"]

    def pairs(og: pa.Scalar, x: pa.Table, y: pa.Table, d: np.ndarray) -> pa.Table:
        both = pa.concat_arrays([v["seq"].combine_chunks() for v in (x, y)])
        place = np.empty(len(both), np.int64)
        place[np.array(pc.sort_indices(both.cast(pa.binary())))] = np.arange(len(both))
        i, j = np.triu_indices(len(x), 1) if x is y else (v.ravel() for v in np.indices(d.shape))
        first = place[i] < place[len(x) + j]
        a, b = np.where(first, i, len(x) + j), np.where(first, len(x) + j, i)
        return pa.table({"og": pa.repeat(og, len(i)), "a": both.take(pa.array(a)), "b": both.take(pa.array(b)), "d": pa.array(d[i, j], pa.int32())})

    return text_tiles(records.select("og", "seq").distinct(), BLOCK, pairs, f"og {kind}, a string, b string, d int")


def row_medians(records: DataFrame) -> DataFrame:
    """og, id, median: each record's median distance to all records of its family, with the zero to itself.

    Distances between texts are counted by how many records have the text, where the distances are made, and leave the
    task as a row for each text and distance; the median comes from these counts.
    """
    texts = staged(records.where("og is not null and seq is not null").groupBy("og", "seq").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep")), "texts")
    kinds = dict(texts.dtypes)

    def counts(og: pa.Scalar, x: pa.Table, y: pa.Table, d: np.ndarray) -> pa.Table:
        reps, ds, copies = [], [], []
        for own, other, m in ((x, y, d), (y, x, d.T)) if x is not y else ((x, x, d),):
            width, weights = int(m.max(initial=0)) + 1, other["copies"].to_numpy()
            found = np.array([np.bincount(row, weights, width) for row in m]).reshape(len(own), width)
            at, distance = np.nonzero(found)
            reps.append(own["rep"].combine_chunks().take(pa.array(at)))
            ds.append(distance)
            copies.append(found[at, distance].astype(np.int64))
        n = sum(map(len, ds))
        return pa.table({"og": pa.repeat(og, n), "rep": pa.concat_arrays(reps), "d": pa.array(np.concatenate(ds), pa.int32()), "copies": pa.array(np.concatenate(copies))})

    both = text_tiles(texts, BLOCK * WIDER, counts, f"og {kinds['og']}, rep {kinds['rep']}, d int, copies long")
    summed = both.groupBy("og", "rep", "d").agg(F.sum("copies").alias("copies"))
    medians = summed.groupBy("og", "rep").agg(F.percentile("d", F.lit(0.5), F.col("copies")).alias("median"))
    # Staged, as what follows reads medians several times.
    known = staged(texts.join(medians, ["og", "rep"]).select("og", "seq", "median"), "medians")
    return records.select("og", "id", "seq").join(known, ["og", "seq"]).select("og", "id", "median")


def zscore_outliers(medians: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Medians with their z-score in the family (population deviation) and whether it reaches the threshold."""
    per = Window.partitionBy("og")
    z = F.when(F.stddev_pop("median").over(per) > 0, (F.col("median") - F.avg("median").over(per)) / F.stddev_pop("median").over(per)).otherwise(0.0)
    return medians.withColumn("z", z).withColumn("outlier", F.col("z") >= threshold)


#: A resample takes a record this often at most; with a mean of one, more has a chance below 10^-13.
MOST_OFTEN = 15


def drawn(rate, u):
    """How often a resample takes a record: the quantile of a uniform number u in a Poisson distribution of that rate."""
    term = upto = F.exp(-rate)
    count = F.lit(0)
    for k in range(MOST_OFTEN):
        count = count + (u >= upto).cast("int")
        term = term * rate / (k + 1)
        upto = upto + term
    return count


def bootstrap_outliers(medians: DataFrame, threshold: float = 3.0, sample: int = 100, rounds: int = 100) -> DataFrame:
    """As zscore_outliers, with the mean and deviation averaged over resamples of a family's medians.

    Each resample takes each record a Poisson number of times, `sample` records (or the family's size, if less) in the
    mean. The number comes from a hash of the record's id and the resample, so results are the same at any partitioning,
    and a resample is three sums that tasks add up: no family is gathered. Resamples that take no record don't count.
    """
    sizes = medians.groupBy("og").agg(F.count(F.lit(1)).alias("_size"))
    rate = F.least(F.lit(1.0), sample / F.col("_size"))
    # Each digest has the numbers of four resamples.
    digest = F.md5(F.concat_ws("|", F.col("id").cast("string"), F.col("_block").cast("string")))
    four = F.array(*(F.struct((F.col("_block") * 4 + j).alias("rep"), (F.conv(F.substring("_digest", 8 * j + 1, 8), 16, 10).cast("double") / float(1 << 32)).alias("u")) for j in range(4)))
    blocks = medians.join(sizes, "og").select("og", "median", rate.alias("_rate"), "id", F.explode(F.sequence(F.lit(0), F.lit((rounds + 3) // 4 - 1))).alias("_block")).withColumn("_digest", digest)
    each = blocks.select("og", "median", "_rate", F.explode(four).alias("r")).where(F.col("r.rep") < rounds).select("og", "median", "r.rep", drawn(F.col("_rate"), F.col("r.u")).alias("w"))
    m, w = F.col("median").cast("double"), F.col("w")
    sums = each.groupBy("og", "rep").agg(F.sum("w").alias("n"), F.sum(w * m).alias("s"), F.sum(w * m * m).alias("q")).where("n > 0")
    mean = F.col("s") / F.col("n")
    stats = sums.groupBy("og").agg(F.avg(mean).alias("_mean"), F.avg(F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean))).alias("_deviation"))
    z = F.when(F.col("_deviation") > 0, (m - F.col("_mean")) / F.col("_deviation")).otherwise(0.0)
    return medians.join(stats, "og", "left").select("og", "id", m.alias("median"), F.coalesce(z, F.lit(0.0)).alias("z")).withColumn("outlier", F.col("z") >= threshold)


def iqr_outliers(medians: DataFrame, threshold: float = 3.0, as_written: bool = False) -> DataFrame:
    """Medians outside q1 - t * iqr to q3 + t * iqr.

    as_written: the rule that the method's first description has, which flags values below q1 by less than t times the
    range, and values above it only by an impossible condition.
    """
    quartiles = medians.groupBy("og").agg(F.percentile("median", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    m, q1, q3 = F.col("median"), F.col("q")[0], F.col("q")[1]
    iqr = q3 - q1
    repaired = (m < q1 - iqr * threshold) | (m > q3 + iqr * threshold)
    written = F.when(iqr > 0, ((m < q1) & ((q1 - m) / iqr < threshold)) | ((m > q1) & ((q3 - m) / iqr > threshold))).otherwise(False)
    return medians.join(quartiles, "og").select("og", "id", "median", q1.alias("q1"), q3.alias("q3"), (written if as_written else repaired).alias("outlier"))


def lof(neighbours: DataFrame, group: str = "label", cut: float = 1.5) -> DataFrame:
    """Local outlier factor from a table of nearest neighbours (group, id, other, place, d): the ratio of the neighbours' density to one's own."""
    reach = neighbours.groupBy(group, "id").agg(F.max("d").alias("k_distance"))
    joined = neighbours.join(reach.select(group, F.col("id").alias("other"), F.col("k_distance").alias("other_k")), [group, "other"])
    density = joined.groupBy(group, "id").agg((1.0 / (F.avg(F.greatest("d", "other_k")) + 1e-10)).alias("lrd"))
    near = neighbours.join(density.select(group, F.col("id").alias("other"), F.col("lrd").alias("other_lrd")), [group, "other"])
    factor = near.groupBy(group, "id").agg(F.avg("other_lrd").alias("near_lrd")).join(density, [group, "id"]).withColumn("lof", F.col("near_lrd") / F.col("lrd"))
    return factor.select(group, "id", "lof", (F.col("lof") > cut).alias("outlier"))


def lof_neighbours(points: DataFrame, edges, group: str = "label") -> DataFrame:
    """Nearest neighbours for lof: 20, or half of a group below 20 records (two at least), and never more than the others there are.

    edges: a function (points, k, group) -> edge table with d2.
    """
    rule = F.when(F.col("n") >= 20, 20).otherwise(F.greatest(F.lit(2), F.floor(F.col("n") / 2)))
    sizes = points.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("k", F.least(rule, F.col("n") - 1).cast("int"))
    found = None
    for k in sorted(r["k"] for r in sizes.select("k").distinct().collect()):  # at most 11 sizes: 1 to 9, 19 and 20
        mine = points.join(sizes.where(F.col("k") == k).select(group), group, "left_semi")
        one = edges(mine, k, group).withColumn("d", F.sqrt("d2"))
        found = one if found is None else found.unionByName(one)
    return found


def lof_of_scores(scored: DataFrame, score: str = "z", group: str = "og", cut: float = 1.5) -> DataFrame:
    """group, id, lof and outlier of one-dimensional scores, scaled by each group's median and interquartile range."""
    points = robust_scale(scored, score, group).select(group, "id", F.array("scaled").alias("vec"))
    return lof(lof_neighbours(points, knn_edges, group), group, cut)


def robust_scale(table: DataFrame, value: str, group: str) -> DataFrame:
    """(value - median) / interquartile range of its group; the range counts as one where it is zero."""
    stats = table.groupBy(group).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"))
    iqr = F.col("_q")[2] - F.col("_q")[0]
    return table.join(stats, group).withColumn("scaled", (F.col(value) - F.col("_q")[1]) / F.when(iqr > 0, iqr).otherwise(1.0)).drop("_q")


def combine_filters(records: DataFrame, first: DataFrame | None = None, second: DataFrame | None = None) -> DataFrame:
    """Records without the outliers (og, id): those of both tables where both are given, those of one where one is, all records else."""
    if first is None and second is None:
        return records
    if first is None or second is None:
        out = first if first is not None else second
    else:
        out = first.select("og", "id").intersect(second.select("og", "id"))
    return records.join(out.select("og", "id"), ["og", "id"], "left_anti")
