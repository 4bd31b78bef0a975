"""Operators on literal tables with known results, and against second implementations."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import collapse, families, genetic_code, hits, intervals, records, reports, statistics, taxonomy, text_mining, trees


def test_transcripts_are_numbered_in_order(spark):
    rows = [("NODE_1_cov_9.0_x", 0, "A" * 199), ("NODE_2_cov_3.14159_x", 1, "A" * 200), ("plain", 2, "A" * 201)]
    frame = spark.createDataFrame(rows, "id string, ord long, seq string")
    got = records.renumber(records.keep_long(frame), F.lit("T")).orderBy("ord").collect()
    assert [r["new_id"] for r in got] == ["T|Transcript_1_Length_200_Cov_3.14", "T|Transcript_2_Length_201"]
    many = spark.range(1000).select(F.col("id").cast("string").alias("id"), (1000 - F.col("id")).alias("ord"), F.lit("A").alias("seq"))
    numbers = {r["id"]: r["n"] for r in records.row_numbers(many.repartition(7), "ord").collect()}
    assert numbers == {str(k): 1000 - k for k in range(1000)}


def test_longest_isoforms(spark):
    rows = [("L1", "p1", 0, 9), ("L1", "p2", 1, 12), ("L1", "p3", 2, 12), (None, "p4", 3, 9), (None, "p5", 4, 15), ("L9", None, 5, 18)]
    frame = spark.createDataFrame([(a, b, c, "A" * n) for a, b, c, n in rows], "locus string, protein string, ord long, seq string")
    assert sorted((str(r["locus"]), r["protein"]) for r in records.longest_isoform(frame).collect()) == [("L1", "p2"), ("None", "p5")]
    assert sorted(r["protein"] for r in records.longest_isoform(frame, "keep").collect()) == ["p2", "p4", "p5"]


def test_semi_and_anti_make_the_whole(spark):
    frame = spark.range(20).select(F.col("id").cast("string").alias("id"))
    a, b = (frame.where(F.col("id").cast("int") % k == 0) for k in (3, 5))
    found, rest = records.split_by_hits(frame, [a, b])
    assert found.count() + rest.count() == 20 and rest.join(found, "id").count() == 0 and found.count() == 9


def test_last_and_best_hits(spark):
    rows = [("q1", "h1", 90.0, 0), ("q1", "h2", 80.0, 1), ("q2", "h3", 5.0, 2), ("q2", "h4", 5.0, 3)]
    frame = spark.createDataFrame(rows, "qseqid string, sseqid string, bitscore double, ord long")
    assert {r["qseqid"]: r["sseqid"] for r in hits.one_hit(frame).collect()} == {"q1": "h2", "q2": "h4"}
    assert {r["qseqid"]: r["sseqid"] for r in hits.one_hit(frame, "bitscore").collect()} == {"q1": "h1", "q2": "h3"}


def test_genetic_code_of_alignments(spark):
    seqs = spark.createDataFrame([("a", "ATGAAACTG"), ("b", "CAGTTTCAT")], "id string, seq string")
    schema = "id string, q_from int, q_to int, q_frame int, q_seq string, h_seq string"
    pairs = lambda *rows: sorted(tuple(r) for r in genetic_code.aligned_codons(seqs, spark.createDataFrame(rows, schema)).collect())
    assert pairs(("a", 1, 9, 1, "MK-L", "MRAL")) == [("AAA", "R"), ("ATG", "M"), ("CTG", "L")]
    assert pairs(("a", 1, 9, 1, "MKL", "M-L")) == [("ATG", "M"), ("CTG", "L")]
    assert pairs(("b", 9, 1, -1, "MKL", "MKL")) == [("AAA", "K"), ("ATG", "M"), ("CTG", "L")]


def consensus(spark, rows):
    frame = spark.createDataFrame([r for r, n in rows for _ in range(n)], "codon string, aa string")
    return {r["codon"]: r for r in genetic_code.codon_consensus(frame).collect()}


def test_codon_verdicts(spark):
    got = consensus(spark, [(("TAA", "Q"), 9), (("TAA", "E"), 1), *((("AAA", a), n) for a, n in (("K", 3), ("A", 2), ("B", 2), ("C", 2), ("D", 1))), (("CTG", "S"), 2), (("CTG", "L"), 2), (("NNN", "X"), 5)])
    assert (got["TAA"]["predicted_aa"], got["TAA"]["verdict"], got["TAA"]["standard_aa"]) == ("Q", "Reassigned", "STOP")
    assert (got["TAG"]["predicted_aa"], got["TAG"]["verdict"]) == ("STOP", "Same")
    assert (got["GGG"]["predicted_aa"], got["GGG"]["verdict"]) == ("?", "Uncertain")
    assert (got["AAA"]["predicted_aa"], got["AAA"]["verdict"], got["AAA"]["aa_frequency"], got["AAA"]["aa_count"]) == ("k", "Same", 3, 10)
    assert got["CTG"]["predicted_aa"] == "L"
    assert len(got) == 64


def test_rare_codons_are_left_out_unless_they_are_stops(spark):
    frame = spark.range(100_000).select(F.lit("ATG").alias("codon"), F.lit("M").alias("aa"))
    frame = frame.union(spark.createDataFrame([("GGG", "G"), ("TGA", "W")], frame.schema))
    got = {r["codon"]: r["verdict"] for r in genetic_code.codon_consensus(frame).collect()}
    assert "GGG" not in got and got["TGA"] == "Same" and got["ATG"] == "Same"


def test_size_filter(spark):
    lengths = {"a": (10, 100, 100, 300), "b": (90, 100, 100, 110, 300), "c": (50, 60, 70)}
    frame = spark.createDataFrame([(og, f"{og}{k}", "A" * n) for og, ns in lengths.items() for k, n in enumerate(ns)], "og string, id string, seq string")
    assert sorted(r["id"] for r in families.size_filter(frame).collect()) == ["b0", "b1", "b2", "b3"]


def test_median_distances_and_z_scores(spark):
    frame = spark.createDataFrame([("f", 1, "AAAA"), ("f", 2, "AAAC"), ("f", 3, "CCCCCCC"), ("f", 4, "AAAA")], "og string, id long, seq string")
    got = {r["id"]: r["median"] for r in families.row_medians(frame).collect()}
    d = lambda a, b: next(r["d"] for r in families.distances(frame).collect() if {r["a"], r["b"]} == {a, b})
    far = d("AAAA", "CCCCCCC")
    assert got == {1: np.median([0, 0, 1, far]), 4: np.median([0, 0, 1, far]), 2: np.median([0, 1, 1, d("AAAC", "CCCCCCC")]), 3: np.median([0, far, far, d("AAAC", "CCCCCCC")])}
    z = families.zscore_outliers(spark.createDataFrame([("f", 1, 2.0), ("f", 2, 2.0), ("f", 3, 7.0), ("g", 4, 1.0)], "og string, id long, median double"))
    assert [round(r["z"], 6) for r in z.orderBy("id").collect()] == [-0.707107, -0.707107, 1.414214, 0.0]


def test_both_quartile_rules(spark):
    frame = spark.createDataFrame([("f", k, float(v)) for k, v in enumerate((1, 2, 3, 4, 20))], "og string, id long, median double")
    flagged = lambda **k: [r["median"] for r in families.iqr_outliers(frame, 3.0, **k).collect() if r["outlier"]]
    assert flagged() == [20.0] and flagged(as_written=True) == [1.0]


def test_bootstrap_is_seeded_and_near_the_plain_scores(spark):
    frame = spark.createDataFrame([("f", k, float(k % 7)) for k in range(60)] + [("f", 99, 90.0)], "og string, id long, median double")
    one, two = ({r["id"]: r["z"] for r in families.bootstrap_outliers(frame).collect()} for _ in range(2))
    assert one == two and max(one, key=one.get) == 99
    assert one == {r["id"]: r["z"] for r in families.bootstrap_outliers(frame.repartition(7)).collect()}
    plain = {r["id"]: r["z"] for r in families.zscore_outliers(frame).collect()}
    assert all(abs(one[k] - plain[k]) < 0.15 * max(1, abs(plain[k])) + 0.4 for k in plain)


def test_resamples_are_of_the_stated_size(spark):
    from pyspark.sql import functions as F

    rows = spark.range(200_000).select((F.md5(F.col("id").cast("string")).substr(1, 8)).alias("h")).select((F.conv("h", 16, 10).cast("double") / float(1 << 32)).alias("u"))
    for rate in (1.0, 0.2):
        w = rows.select(families.drawn(F.lit(rate), F.col("u")).alias("w")).agg(F.avg("w"), F.var_pop("w"), F.max("w")).first()
        assert abs(w[0] - rate) < 0.02 and abs(w[1] - rate) < 0.03 and w[2] >= 3


@pytest.mark.parametrize("block", [4, 1024])
def test_nearest_points_equal_all_pairs(spark, monkeypatch, block):
    """Groups of one point to two hundred, with equal points, ties, points without a group and rows in one dimension."""
    import numpy as np

    monkeypatch.setattr(text_mining, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = [(int(g), k * 7 % 1009, [float(x) for x in v]) for g, n in ((0, 200), (1, 12), (2, 4), (3, 1), (4, 90)) for k, v in enumerate(rng.integers(0, 3, (n, 3)) if g == 4 else rng.normal(size=(n, 3)) * (1 + 50 * (g == 1)))]
    rows += [(None, 5000 + k, [0.0, 0.0, 0.0]) for k in range(9)]
    frame = spark.createDataFrame(rows, "label int, id long, vec array<double>")
    want = set()
    for g, i, x in rows:
        others = [(sum((p - q) * (p - q) for p, q in zip(x, y)), j) for h, j, y in rows if h == g and j != i]
        if g is not None and len(others) + 1 > 5:
            want |= {(g, i, j, place) for place, (_, j) in enumerate(sorted(others)[:5], 1)}
    assert {tuple(r)[:4] for r in text_mining.knn_edges(frame, 5).collect()} == want
    single = frame.withColumn("vec", F.slice("vec", 1, 1))
    assert text_mining.knn_edges(single, 5).count() == len(want)


@pytest.mark.parametrize("k", [1, 5, 8, 9])
def test_kmer_counts(spark, monkeypatch, k):
    rng = random.Random(k)
    rows = [(rng.choice(["g", "h", None]), "".join(rng.choice("ACD*") for _ in range(rng.randrange(0, 60)))) for _ in range(80)] + [("g", None), ("g", "MÄRZÄRZÄMÄRZ"), ("h", "A\nCDACDACDACDA")]
    want = {}
    for og, seq in rows:
        for x in {seq[i : i + k] for i in range(len(seq or "") - k + 1)} if seq else ():
            if "\n" not in x:
                want[og, x] = want.get((og, x), 0) + 1
    frame = spark.createDataFrame(rows, "og string, seq string")
    for held in (50, 10**6):
        monkeypatch.setattr(text_mining, "HELD", held)
        assert {(r["og"], r["kmer"]): r["df"] for r in text_mining.kmer_document_frequency(frame, k).collect()} == want


def test_votes(spark):
    schema = "cluster int, id string, domain string, supergroup string, major string, minor string"
    frame = spark.createDataFrame([(1, str(k), x, y, "m", "n") for k, (x, y) in enumerate(zip("AAABB", "AAAAB"))], schema)
    won = {(r["level"], r["label"]) for r in text_mining.cluster_votes(frame).collect()}
    assert won == {("supergroup", "A"), ("major", "m"), ("minor", "n")}


def test_distinct_queries(spark):
    frame = spark.createDataFrame([("q1", "A"), ("q1", "A"), ("q2", "A"), ("q2", "B"), ("q3", None)], "query_seq string, k string")
    assert [tuple(r) for r in reports.distinct_query_frequency(frame, ["k"]).collect()] == [("A", 2), ("B", 1)]
    assert [tuple(r) for r in reports.top(frame, "k", most=1).collect()] == [("A", 2)]


def brute_neighbours(points, k):
    out = set()
    for i, a in enumerate(points):
        far = sorted((float(((a - b) ** 2).sum()), j) for j, b in enumerate(points) if j != i)
        out |= {(i, j) for _, j in far[:k]}
    return out


@pytest.mark.parametrize(("n", "edges"), [(10, 0), (11, 110), (25, 250)])
def test_neighbours_need_more_than_k(spark, n, edges):
    rng = np.random.default_rng(n)
    points = rng.normal(size=(n, 4))
    frame = spark.createDataFrame([(k, 0, p.tolist()) for k, p in enumerate(points)], "id long, label int, vec array<double>")
    got = {(r["id"], r["other"]) for r in text_mining.knn_edges(frame).collect()}
    assert len(got) == edges and (not edges or got == brute_neighbours(points, 10))


def brute_ward(rows, threshold):
    clusters = [[k] for k in range(len(rows))]
    while len(clusters) > 1:
        best = min(
            ((np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(rows[a].mean(0) - rows[b].mean(0)), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        )
        if not best[0] < threshold:
            break
        clusters[best[1]] += clusters.pop(best[2])
    return {frozenset(c) for c in clusters}


def test_ward_against_centroids():
    rng = np.random.default_rng(1)
    for threshold in (1.0, 2.0, 4.0):
        rows = rng.normal(size=(25, 3))
        labels = text_mining.ward(rows, threshold)
        assert {frozenset(np.flatnonzero(labels == x).tolist()) for x in set(labels)} == brute_ward(rows, threshold)


def test_steps_of_third_places(spark):
    rows = ["AAGAACAAA", "aag", "AA", "", None, "AAGAAT", "AAA" * 199 + "AAGT"]
    got = {r["step"]: r["sequences"] for r in statistics.gc3_steps(spark.createDataFrame([(x,) for x in rows], "seq string").repartition(3)).collect()}
    assert got == {67: 1, 100: 1, 50: 1, 1: 1}


def test_ward_of_a_graph_in_small_memory():
    import tracemalloc

    rng = np.random.default_rng(4)
    for n, most in ((60, 12), (200, 25)):
        links = {(i, int(j)) for i in range(n) for j in i // most * most + rng.permutation(most)[:10]}
        rows = np.zeros((n, n))
        for i, j in links:
            rows[i, j] = 1
        # Tied pairs are merged in the order of their places; the exact distances of the second implementation have them too.
        assert len(set(text_mining.ward_of_graph(n, links, 3.0))) < n
        assert text_mining.ward_of_graph(n, links, 3.0) == exact_ward(rows, 3.0)
    assert text_mining.ward_of_graph(3, {(0, 1)}, 3.0) is None
    n = 2000
    links = {(i, (i * 7 + j * (1 + i % 3)) % n) for i in range(n) for j in range(10)}
    tracemalloc.start()
    text_mining.ward_of_graph(n, links, 3.0)
    ward_peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ward_peak < 30e6  # a matrix of so many rows has 32 MB


def exact_ward(rows, threshold):
    from fractions import Fraction

    members = {i: [i] for i in range(len(rows))}
    ones = rows.astype(int)
    total = {i: ones[i].copy() for i in members}
    pair = lambda a, b: Fraction(2 * int(((len(members[b]) * total[a] - len(members[a]) * total[b]) ** 2).sum()), len(members[a]) * len(members[b]) * (len(members[a]) + len(members[b])))
    d = {(a, b): pair(a, b) for a in members for b in members if a < b}
    while d:
        (a, b), best = min(d.items(), key=lambda e: (e[1], e[0]))
        if not best < threshold**2:
            break
        members[a] += members.pop(b)
        total[a] = total[a] + total.pop(b)
        d = {k: v for k, v in d.items() if b not in k and a not in k} | {(min(a, c), max(a, c)): pair(min(a, c), max(a, c)) for c in members if c != a}
    return [next(c for c, m in members.items() if i in m) for i in range(len(rows))]


def test_local_outlier_factor(spark):
    rng = np.random.default_rng(5)
    points = np.vstack([rng.normal(size=(30, 2)), [[12.0, 12.0]]])
    frame = spark.createDataFrame([(k, 0, p.tolist()) for k, p in enumerate(points)], "id long, label int, vec array<double>")
    near = families.lof_neighbours(frame, text_mining.knn_edges)
    got = {r["id"]: (r["lof"], r["outlier"]) for r in families.lof(near).collect()}
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    nb = [np.argsort(d[i] + (np.arange(31) == i) * 1e9)[:20] for i in range(31)]
    kd = [d[i][nb[i]].max() for i in range(31)]
    lrd = [1 / (np.mean([max(d[i, j], kd[j]) for j in nb[i]]) + 1e-10) for i in range(31)]
    for i in range(31):
        assert got[i][0] == pytest.approx(np.mean([lrd[j] for j in nb[i]]) / lrd[i])
    assert got[30][1] and not got[0][1]


def test_runs_of_up_to_five_kmers_by_brute_force(spark, data):
    from collections import Counter, defaultdict

    from seqloom.plans import catalogue, substrate

    families = defaultdict(dict)
    for r in substrate.families(spark, data).collect():
        kmers = [r["seq"][i : i + 5] for i in range(len(r["seq"]) - 4)]
        families[r["og"]][r["id"]] = Counter(" ".join(kmers[i : i + n]) for n in range(1, 6) for i in range(len(kmers) - n + 1))
    want = {}
    for og, own in families.items():
        df = Counter(t for terms in own.values() for t in terms)
        for key, terms in own.items():
            raw = {t: tf * (np.log((1 + len(own)) / (1 + df[t])) + 1) for t, tf in terms.items() if df[t] >= 5}
            norm = np.sqrt(sum(x * x for x in raw.values()))
            want |= {(og, key, t): x / norm for t, x in raw.items()}
    got = {(r["og"], r["id"], r["term"]): r["weight"] for r in catalogue.QUERIES["kmer_run_tfidf"](spark, data).collect()}
    assert got.keys() == want.keys() and any(" " in k[2] for k in got)
    assert all(abs(got[k] - want[k]) < 2e-6 for k in got)


def test_text_neighbours_fill_up(spark):
    """The nearest by the distances of all rows, those without a shared term or without any term as well."""
    vectors = {1: {"x": 1.0}, 2: {"x": 0.6, "y": 0.8}, 3: {"y": 1.0}, 4: {"z": 1.0}, 5: {}, 6: {}, 7: {"z": 1.0}, 8: {"u": 1.0}}
    weights = spark.createDataFrame([("f", k, t, w) for k, v in vectors.items() for t, w in v.items()], "og string, id long, term string, weight double")
    members = spark.createDataFrame([("f", k) for k in vectors], "og string, id long")
    got = sorted((r["id"], r["place"], r["other"]) for r in text_mining.text_neighbours(weights, members, 4).collect())
    d2 = lambda a, b: round(sum((vectors[a].get(t, 0) - vectors[b].get(t, 0)) ** 2 for t in "xyzu"), 9)
    assert got == [(a, n, b) for a in vectors for n, b in enumerate(sorted((b for b in vectors if b != a), key=lambda b: (d2(a, b), b))[:4], 1)]


def test_neighbours_of_equal_texts_are_found_once_a_text(spark, monkeypatch):
    texts = ["ACDEFGHIKL", "ACDEFGHIKM", "ACDEFGHAAA", "LLLLLLLLLL", "AC"]
    rows = [("f", k, texts[k * 7 % 5]) for k in range(60)] + [("g", 100, None), ("g", 101, "ACDEFG")]
    frame = spark.createDataFrame(rows, "og string, id long, seq string").repartition(3)
    weights = {}
    for r in text_mining.tfidf(frame, longest=2).collect():
        weights.setdefault(r["id"], {})[r["term"]] = r["weight"]
    members, vectors = text_mining.tfidf_vectors(frame, longest=2)
    assert vectors.count() == len({texts.index(seq) for _, k, seq in rows if k in weights}) and members.count() == 62
    d2 = lambda a, b: round(sum((weights.get(a, {}).get(t, 0) - weights.get(b, {}).get(t, 0)) ** 2 for t in {*weights.get(a, {}), *weights.get(b, {})}), 9)
    want = [(a, n, b) for og, a, _ in rows for n, b in enumerate(sorted((b for g, b, _ in rows if g == og and b != a), key=lambda b: (d2(a, b), b))[:4], 1)]
    for size in (text_mining.VECTORS, 2):
        monkeypatch.setattr(text_mining, "VECTORS", size)
        assert sorted((r["id"], r["place"], r["other"]) for r in text_mining.nearest_records(members, vectors, 4).collect()) == sorted(want)


def test_tfidf_of_runs(spark):
    frame = spark.createDataFrame([("f", k, "ABCDEFGH" + "XYZ"[k % 3] * 6) for k in range(6)], "og string, id long, seq string")
    got = text_mining.tfidf(frame, longest=2, least_df=5).collect()
    assert {r["term"] for r in got} >= {"ABCDE", "ABCDE BCDEF"} and all(" " not in r["term"] or len(r["term"]) == 11 for r in got)
    for k in range(6):
        assert sum(r["weight"] ** 2 for r in got if r["id"] == k) == pytest.approx(1)
    assert text_mining.tfidf(frame, least_df=7).count() == 0


def test_collapse(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("ACGT") for _ in range(400))
    part = list(long[100:300])
    for k in (10, 90, 150):
        part[k] = "A" if part[k] != "A" else "C"
    bad = list(long[100:200])
    for k in range(0, 100, 10):
        bad[k] = "A" if bad[k] != "A" else "C"
    rows = [("f", "long", long), ("f", "copy", long), ("f", "part", "".join(part)), ("f", "bad", "".join(bad)), ("g", "other", long[:50])]
    got = {r["id"]: r["kept_id"] for r in collapse.collapse(spark.createDataFrame(rows, "og string, id string, seq string")).collect()}
    assert got == {"long": "copy", "copy": "copy", "part": "copy", "bad": "bad", "other": "other"}


def test_collapse_of_short_sequences_meets_few(spark, monkeypatch):
    rng = random.Random(4)
    seqs = sorted({"".join(rng.choice("ACDEFGHIKL") for _ in range(rng.randint(0, 40))) for _ in range(400)})
    seqs += sorted({s[a : a + n] for s in seqs[1:80] for a, n in ((0, len(s) // 2), (len(s) // 3, 3), (2, len(s)))} - set(seqs))
    seqs += [s[:20] + "W" + s[21:] for s in seqs if len(s) > 35][:20]
    rows = [("f", k, s) for k, s in enumerate(seqs)]
    want, kept = {}, []
    for _, k, s in sorted(rows, key=lambda r: (-len(r[2]), r[1])):
        want[k] = next((i for i, t in kept if collapse.covered(s, t, 0.97)), k)
        kept += [(k, s)] if want[k] == k else []
    real, calls = collapse.covered, []
    monkeypatch.setattr(collapse, "covered", lambda *a: calls.append(a) or real(*a))
    assert {k: h for (h, _), k in zip(collapse.fold([(s, k) for _, k, s in rows], 0.97), [r[1] for r in sorted(rows, key=lambda r: (-len(r[2]), r[1]))], strict=True)} == want
    assert len(calls) < 5 * len(rows) and len(kept) < len(rows) - 50
    monkeypatch.undo()
    frame = spark.createDataFrame(rows, "og string, id long, seq string")
    assert {r["id"]: r["kept_id"] for r in collapse.collapse(frame).collect()} == want


E4 = ("Eukaryota", "Bacteria")


@pytest.mark.parametrize(
    ("lineage", "want"),
    [
        (["Eukaryota", "Opisthokonta", "Metazoa", "a", "b", "c"], ("Eukaryota", "Opisthokonta", "Metazoa", "c")),
        (["Eukaryota", "Opisthokonta", "Metazoa", "a"], ("Eukaryota", "Opisthokonta", "Metazoa", "a")),
        (["Eukaryota", "Opisthokonta"], ("Unknown",) * 4),
        (["Eukaryota", "Viridiplantae"], ("Eukaryota", "Archaeplastida", "Viridiplantae", "Viridiplantae incertae sedis")),
        (["Eukaryota", "Sar", "Stramenopiles", "X"], ("Eukaryota", "SAR", "Stramenopila", "X")),
        (["Eukaryota", "Picozoa"], ("Eukaryota", "Orphan", "Orphan incertae sedis", "Picozoa")),
        (["Bacteria", "P"], ("Bacteria", "Bacteria incertae sedis", "Bacteria Incertae sedis", "P")),
        (["Archaea", "P", "Q"], ("Archaea", "P", "Q", "Q")),
        (["Eukaryota", "Foo"], ("Unknown",) * 4),
        ([], ("Unknown",) * 4),
        (["Viruses", "a", "b", "c"], ("Unknown",) * 4),
    ],
)
def test_lineage_rules(spark, lineage, want):
    row = spark.createDataFrame([(lineage,)], "q array<string>").select(taxonomy.reduce_lineage(F.col("q")).alias("r")).first()["r"]
    assert tuple(row) == want


def test_look_up_by_species_then_genus(spark):
    nodes = [(1, None, "superkingdom", "Bacteria"), (2, 1, "phylum", "P"), (3, 2, "genus", "Gen"), (4, 3, "species", "Gen spec"), (5, 2, "no rank", "hidden"), (6, 5, "genus", "Deep")]
    known = taxonomy.lineages(spark.createDataFrame(nodes, "tax_id long, parent_id long, rank string, name string"))
    assert {r["name"]: r["lineage"] for r in known.collect()}["Deep"] == ["Bacteria", "P", "Deep"]
    taxa = spark.createDataFrame([("Gen_spec_x",), ("Gen_sp",), ("None_here",), ("One",)], "taxon string")
    got = {r["taxon"]: r["minor"] for r in taxonomy.look_up(taxa, known).collect()}
    assert got == {"Gen_spec_x": "Gen", "Gen_sp": "Gen", "None_here": "Unknown", "One": "Unknown"}


def test_sisters_of_a_small_tree(spark):
    text = "((X|s1|OG:1,X|s2|OG:1):1,(Y|s3|OG:1,Z|s4|OG:3):1);"
    nodes = trees.from_newick(spark.createDataFrame([("t", text)], "tree_id string, newick string"))
    leaves = nodes.where("is_leaf").select("tree_id", "node_id", F.split_part("name", F.lit("|"), F.lit(1)).alias("taxon"), F.split_part("name", F.lit("|"), F.lit(1)).alias("prefix"), "name")
    sisters = trees.Sisters(leaves, trees.Forest(nodes))
    rows = sisters.rows()
    names = {r["node_id"]: r["name"].split("|")[1] for r in leaves.collect()}
    got = {}
    for r in rows.collect():
        got.setdefault(names[r["leaf"]], set()).add(names[r["sister"]])
    assert got == {"s1": {"s3", "s4"}, "s2": {"s3", "s4"}, "s3": {"s4"}, "s4": {"s3"}}
    verdict = {names[r["node_id"]]: r["verdict"] for r in trees.branch_verdicts(nodes).collect()}
    assert verdict == {"s1": "short", "s2": "short", "s3": "short", "s4": "long"}
    lists = {names[r["leaf"]]: r["n_sister_taxa"] for r in sisters.lists().collect()}
    assert lists == {"s1": 2, "s2": 2, "s3": 1, "s4": 1}
    assert sisters.lists(most=1).where("sister_taxa = 'More-than-1'").count() == 2


def test_a_tree_of_one_prefix_has_no_sisters(spark):
    nodes = trees.from_newick(spark.createDataFrame([("t", "(X|a|1:1,X|b|1:2);")], "tree_id string, newick string"))
    leaves = nodes.where("is_leaf").select("tree_id", "node_id", F.lit("X").alias("taxon"), F.lit("X").alias("prefix"))
    sisters = trees.Sisters(leaves, trees.Forest(nodes))
    assert sisters.rows().count() == sisters.counts().count() == sisters.lists().count() == 0


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_tree_operators_equal_a_walk_of_every_tree(spark, monkeypatch, block):
    """Random forests, bushes and chains, with leaves that lack a taxon, a prefix or a group, against each node's list of leaves."""
    monkeypatch.setattr(intervals, "BLOCK", block)
    rng = random.Random(17)
    rows, below, parents = [], {}, {}
    for t in range(6):
        size = rng.choice([1, 2, 9, 40])
        shape = rng.choice([lambda k: k - 1, lambda k: rng.randrange(k), lambda k: max(0, k - rng.randrange(1, 4))])
        up = {k: None if k == 0 else shape(k) for k in range(size)}
        for k in range(size):
            leaf = k not in set(up.values())
            taxon = rng.choice(["A", "B", "C", "D", None]) if leaf else None
            rows.append((f"t{t}", k * 3 + 1, None if up[k] is None else up[k] * 3 + 1, float(k % 5), leaf, taxon, taxon and rng.choice([taxon, taxon, "P", None]), {"A": "g", "B": "g", "C": "h"}.get(taxon)))
    for r in rows:
        parents[r[0], r[1]] = r[2]
    for r in rows:
        at = r[1]
        while at is not None:
            below.setdefault((r[0], at), []).append(r)
            at = parents[r[0], at]
    nodes = spark.createDataFrame(rows, "tree_id string, node_id long, parent_id long, dist double, is_leaf boolean, taxon string, prefix string, supergroup string")
    forest = trees.Forest(nodes)
    spans = {(r["tree_id"], r["node_id"]): (r["first"], r["last"]) for r in forest.spans.collect()}
    for key, inside in below.items():
        assert {k for k, (first, _) in spans.items() if k[0] == key[0] and spans[key][0] <= first <= spans[key][1]} == {(r[0], r[1]) for r in inside}
    want = set()
    for (tree, node), inside in below.items():
        leaves = [r for r in inside if r[4] and r[1] != node]
        groups = {r[7] for r in leaves} - {None}
        if len(groups) == 1:
            want.add((tree, node, *groups, len(leaves), len({r[5] for r in leaves} - {None})))
    assert {tuple(r) for r in trees.clade_sizes(forest, nodes).collect()} == want and len(want) > 5
    sisters = trees.Sisters(nodes.where("is_leaf").select("tree_id", "node_id", "prefix", "taxon", "supergroup"), forest)
    pairs, stop = {}, {}
    for r in rows:
        at = parents[r[0], r[1]] if r[4] else None
        while at is not None and len({x[6] for x in below[r[0], at] if x[4]} - {None}) < 2:
            at = parents[r[0], at]
        if at is not None and r[5] is not None:
            others = [x for x in below[r[0], at] if x[4] and x[5] not in (None, r[5])]
            if others:
                pairs[r[0], r[1]], stop[r[0], r[1]] = others, at
    assert {(r["tree_id"], r["leaf"], r["stop_id"], r["sister"], r["sister_taxon"]) for r in sisters.rows().collect()} == {(*k, stop[k], x[1], x[5]) for k, v in pairs.items() for x in v}
    assert {(r["tree_id"], r["leaf"], r["stop_id"], r["sisters"], r["sister_taxa"]) for r in sisters.counts().collect()} == {(*k, stop[k], len(v), len({x[5] for x in v})) for k, v in pairs.items()}
    same = lambda v, c: v[0][c] if len({x[c] for x in v}) == 1 else None
    assert {tuple(r) for r in sisters.agreed(["supergroup", "taxon"]).collect()} == {(*k, same(v, 7), same(v, 5)) for k, v in pairs.items()}
    text = lambda v: (n := len({x[5] for x in v}), "More-than-2" if n > 2 else ";".join(sorted({x[5] for x in v})), "Too-many-seqs" if n > 2 else ";".join(map(str, sorted(x[1] for x in v))))
    assert {tuple(r) for r in sisters.lists(2).collect()} == {(*k, *text(v)) for k, v in pairs.items()}


def random_newick(rng, names):
    parts = [f"{n}:{rng.uniform(0.1, 2):.4f}" for n in names]
    while len(parts) > 1:
        rng.shuffle(parts)
        k = min(len(parts), rng.choice([2, 2, 3]))
        parts = parts[k:] + [f"({','.join(parts[:k])}):{rng.uniform(0.1, 2):.4f}"]
    return parts[0].rpartition(":")[0] + ";"


def leaf_distances(root):
    out, leaves = {}, root.leaves()
    for a in leaves:
        up, d, node = {}, 0.0, a
        while node is not None:
            up[node] = d
            d += node.dist
            node = node.parent
        for b in leaves:
            d, node = 0.0, b
            while node not in up:
                d += node.dist
                node = node.parent
            out[a.name, b.name] = d + up[node]
    return out


def test_rerooting_keeps_leaves_and_distances():
    rng = random.Random(7)
    for _ in range(40):
        text = random_newick(rng, [f"l{k}" for k in range(rng.randrange(3, 15))])
        root = trees.resolve(trees.parse_newick(text))
        assert all(len(n.children) in (0, 2) for n in root.walk())
        before = leaf_distances(root)
        mid = trees.midpoint(root)
        after = leaf_distances(mid)
        assert before.keys() == after.keys() and all(after[k] == pytest.approx(before[k]) for k in before)
        deep = {x.name: 0.0 for x in mid.leaves()}
        for leaf in mid.leaves():
            node = leaf
            while node is not None and node is not mid:
                deep[leaf.name] += node.dist
                node = node.parent
        assert max(deep.values()) == pytest.approx(max(before.values()) / 2)
        again = leaf_distances(trees.parse_newick(trees.to_newick(mid)))
        assert all(again[k] == pytest.approx(before[k], abs=1e-3) for k in before)


def test_rooting_by_group():
    text = "((B|1:1,(M|1:1,M|2:1):1):1,((P|1:1,P|2:1):1,(Q|1:1,R|1:1):1):1);"
    root = trees.root_by_group(trees.parse_newick(text), {"M": "Opisthokonta", "P": "SAR", "Q": "SAR", "R": "Discoba", "B": "x"}, {"B": "Bacteria"})
    sides = sorted(sorted(x.name for x in c.leaves()) for c in root.children)
    assert ["M|1", "M|2"] in sides


def test_newick_with_quotes_and_comments():
    root = trees.parse_newick("('a (b)':1.5[note],c:2e-1)root;")
    assert [x.name for x in root.leaves()] == ["a (b)", "c"] and root.name == "root" and root.children[1].dist == 0.2
    assert trees.to_newick(root) == "('a (b)':1.5,c:0.2)root;"
    with pytest.raises(ValueError):
        trees.parse_newick("(a,b)")


def test_ortholog_choice(spark):
    rows = [("t", "a", 1, 9, 1.0), ("t", "b", 3, 1, 2.0), ("t", "c", 3, 2, 2.0), ("t", "d", 3, 2, 1.0), ("u", "e", None, 0, 5.0), ("u", "f", 0, 0, 4.0)]
    frame = spark.createDataFrame(rows, "tree_id string, id string, same int, n_sister_taxa int, root_dist double")
    assert {r["tree_id"]: r["id"] for r in trees.pick_orthologs(frame, ["tree_id"]).collect()} == {"t": "d", "u": "f"}


def test_transcripts_have_stops(spark):
    coding = spark.createDataFrame([("a", "ATG" + "GCC" * 50 + "TAA")], "id string, seq string")
    junk = spark.createDataFrame([("a", "TGAGCC" * 30)], "id string, seq string")
    assert not statistics.looks_like_transcripts(coding) and statistics.looks_like_transcripts(junk)


def test_observed_enc_is_low_for_one_codon_each_and_high_for_even_use(spark):
    from seqloom.functions.sequences import CODONS, code_table

    table = code_table()
    first = {}
    for c in CODONS:
        first.setdefault(table[c], c)
    biased = "".join(c for a, c in first.items() if a != "*") * 40
    even = "".join(c for c in CODONS if table[c] != "*") * 40
    frame = spark.createDataFrame([("biased", biased), ("even", even)], "id string, seq string")
    got = {r["id"]: r["enc"] for r in statistics.observed_enc(frame).collect()}
    assert got["even"] > 55 and got["biased"] < got["even"] - 20


def test_observed_enc_works_each_record_out_by_itself(spark):
    rng = random.Random(8)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (400, 900, 31, 2, 0)] + ["A" * 60, "NNNACGacg" * 9 + "\u00e9AC", None]
    frame = spark.createDataFrame([(f"r{k}", s) for k, s in enumerate(seqs)], "id string, seq string")
    found = statistics.observed_enc(frame)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    one = {r["id"]: r["enc"] for r in found.collect()}
    assert {"r0", "r1"} <= set(one) and not {"r3", "r4", "r7"} & set(one)
    same = statistics.observed_enc(frame.withColumn("id", F.lit("same"))).collect()  # records of one name aren't mixed
    assert sorted(r["enc"] for r in same) == sorted(one.values())


def test_deep_trees_and_lineages_have_no_limit(spark):
    chain = [("t", k, k - 1 if k else None, 1.0) for k in range(300)]
    forest = trees.Forest(spark.createDataFrame(chain, "tree_id string, node_id long, parent_id long, dist double"))
    assert len(forest.ways) == 9 and sum(w.count() for w in forest.ways) < 300 * 9
    assert {(r["node_id"], r["root_dist"]) for r in forest.root_distances().collect()} == {(k, float(k)) for k in range(300)}
    assert {(r["node_id"], r["first"], r["last"]) for r in forest.spans.collect()} == {(k, k, 299) for k in range(300)}
    with pytest.raises(ValueError, match="own ancestor"):
        trees.Forest(spark.createDataFrame([("t", 0, 1, 1.0), ("t", 1, 0, 1.0)], "tree_id string, node_id long, parent_id long, dist double"))
    nodes = spark.createDataFrame([(k, k - 1 if k else None, "clade" if k % 2 else "no rank", f"n{k}") for k in range(250)], "tax_id long, parent_id long, rank string, name string")
    (row,) = taxonomy.lineages(nodes).where("tax_id = 249").collect()
    assert row["lineage"] == [f"n{k}" for k in range(1, 250, 2)]


def test_by_catch_needs_a_winning_supergroup_and_takes_its_members(spark):
    even = [("a", f"q|1", "E", "S0", "M", "N")] + [("a", f"x|{k}", "E", f"S{k % 2}", "M", f"N{k}") for k in range(10)]
    won = [("b", f"q|2", "E", "S0", "M", "N")] + [("b", f"y|{k}", "E", f"S{int(k > 7)}", "M", f"N{k}") for k in range(10)]
    members = spark.createDataFrame(even + won, "cluster string, id string, domain string, supergroup string, major string, minor string")
    got = text_mining.by_catch(members, "q|").collect()
    assert len(got) == 8 and {(r["query_seq"], r["supergroup"], r["major"], r["minor"], r["cluster_taxon"]) for r in got} == {("q|2", "S0", "M", "No-clear-minor-clade", "y")}


def test_by_catch_of_one_cluster_is_the_work_of_many_tasks(spark, monkeypatch):
    members = [("b", f"q|{k}", "E", "S0", "M", "N") for k in range(30)] + [("b", f"y|{k}", "E", "S0", "M", "N") for k in range(70)]
    frame = spark.createDataFrame(members, "cluster string, id string, domain string, supergroup string, major string, minor string")
    monkeypatch.setattr(text_mining, "MET", 4, raising=False)
    got = text_mining.by_catch(frame, "q|").withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == len({(r["query_seq"], r["cluster_seq"]) for r in got}) == 30 * 70 and len({r["task"] for r in got}) > 3


def test_family_pairs_in_blocks_are_all_pairs(spark, monkeypatch):
    rows = [(f"g{k % 2}", k, "".join("ACDE"[(k * 7 + j * k) % 4] for j in range(3 + k % 5))) for k in range(60)]
    frame = spark.createDataFrame(rows, "og string, id long, seq string")
    one = (sorted(families.distances(frame).collect()), sorted(families.row_medians(frame).collect()))
    monkeypatch.setattr(families, "BLOCK", 4)
    assert one == (sorted(families.distances(frame).collect()), sorted(families.row_medians(frame).collect()))


def test_edit_distances_side_by_side():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = np.random.default_rng(5)
    for longest in (6, 40, 150):
        x, y = (["".join(rng.choice(list("ACD\u00e9\U0001f600"), int(n))) for n in rng.integers(0, longest, 9)] + [""] for _ in range(2))
        assert families.edit_distances(x, y).tolist() == [[plain(a, b) for b in y] for a in x]


def test_family_medians_have_no_row_a_pair(spark):
    rows = [(f"g{k % 2}", k, "ACDE"[k % 4] * (k % 9 + 1)) for k in range(80)] + [("g0", 98, None), (None, 99, "ACD")]
    frame = spark.createDataFrame(rows, "og string, id long, seq string")
    assert {r["id"] for r in families.row_medians(frame).collect()} == set(range(80))
    # Distances are made block by block and not in a join of all pairs.
    plan = families.distances(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "levenshtein" not in plan and "FlatMapGroupsInArrow" in plan


def test_hits_of_a_sequence_without_letters_are_covered_beyond_bounds(spark):
    rows = spark.createDataFrame([("q", "s", 3, 1, 1, 4), ("r", "s", 1, 10, 1, 5)], "qseqid string, sseqid string, qstart int, qend int, sstart int, send int")
    queries = spark.createDataFrame([("q", 0), ("r", 20)], "id string, length int")
    got = hits.with_cover(rows, queries, spark.createDataFrame([("s", 10)], "id string, length int")).collect()
    assert {(r["qseqid"], r["query_cover"], r["subject_cover"]) for r in got} == {("q", float("inf"), 40.0), ("r", 50.0, 50.0)}


def test_row_numbers_of_wide_rows(spark):
    # Keys alone are few bytes and are put together, rows aren't.
    wide = F.concat(*(F.sha2(F.concat_ws("|", F.lit(k), "id"), 512) for k in range(6)))
    many = spark.range(0, 20_000, numPartitions=2).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("ord"), wide.alias("seq"))
    got = records.row_numbers(many, "ord").select("ord", "n", F.length("seq")).orderBy("ord").collect()
    assert [r["n"] for r in got] == list(range(1, 20_001))


def test_genetic_codes_that_are_told_by_their_changes():
    from seqloom.functions import sequences

    assert len(sequences.CODES) == 26 and all(len(sequences.code_table(c)) == 64 for c in sequences.CODES)
    assert sequences.code_table(2)["AGA"] == "*" and sequences.code_table(2)["TGA"] == "W" and sequences.code_table(33)["AGG"] == "K"


def test_outliers_of_scores_by_local_density(spark):
    rows = [("a", k, 1.0 + 0.01 * k) for k in range(30)] + [("a", 99, 50.0)] + [("b", k, float(k)) for k in range(4)]
    got = families.lof_of_scores(spark.createDataFrame(rows, "og string, id long, z double"))
    assert {(r["og"], r["id"]) for r in got.where("outlier").collect()} == {("a", 99)} and got.count() == 35
