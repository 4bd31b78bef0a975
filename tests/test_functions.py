"""Sequence and name functions on literal rows with known results."""

import random

import pytest
from pyspark.sql import functions as F

from seqloom.functions import names, sequences


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


def of_seq(spark, column, seq):
    return one(spark, column, "seq string", seq)


def test_gc_by_place(spark):
    row = spark.createDataFrame([("ATGGCCTAA",)], "seq string").select(*(c.alias(n) for n, c in sequences.gc_by_place(F.col("seq")).items())).first()
    assert [round(x, 3) for x in row] == [44.444, 33.333, 33.333, 66.667, 33.333, 100.0]
    assert of_seq(spark, sequences.gc_percent(F.col("seq")), "") is None
    assert of_seq(spark, sequences.gc_percent(F.col("seq")), "acgG") == 75.0
    assert of_seq(spark, sequences.gc_by_place(F.col("seq"))["gc3_4fold"], "ATGATG") is None


def test_fourfold_pairs_of_other_codes(spark):
    assert of_seq(spark, sequences.fourfold_thirds(F.col("seq"), 6), "TACTAA") == "CA" and of_seq(spark, sequences.fourfold_thirds(F.col("seq"), 1), "TACTAA") == ""


@pytest.mark.parametrize(("s", "enc"), [(0, 31.0), (25, 48.65), (50, 60.5), (100, 32.0)])
def test_expected_enc(spark, s, enc):
    assert one(spark, sequences.expected_enc(F.col("s")), "s double", float(s)) == pytest.approx(enc)


@pytest.mark.parametrize(("seq", "codons"), [("ATGTGATAA", "ATGTGA"), ("ATGTGATAAC", "ATGTGATAA"), ("ATGTGATAACC", "ATGTGATAA"), ("ATG", ""), ("", ""), ("AT", "")])
def test_scanned_codons(spark, seq, codons):
    assert of_seq(spark, sequences.scanned(F.col("seq")), seq) == codons


def test_stops_count_in_frame_only(spark):
    assert of_seq(spark, sequences.stops_in(F.col("seq"), "TGA"), "ATGATGATGAAA") == 0
    assert of_seq(spark, sequences.stops_in(F.col("seq"), "TGA"), "TGATGAAAATGA") == 2


@pytest.mark.parametrize(("seq", "euk", "prok"), [("ATGGCCTAA", True, True), ("ATGGCCTA", False, False), ("TTGGCCTAA", False, True), ("CTGGCCTAA", False, False), ("atggcctaa", True, True)])
def test_complete_coding_sequences(spark, seq, euk, prok):
    assert of_seq(spark, sequences.is_complete_cds(F.col("seq")), seq) is euk and of_seq(spark, sequences.is_complete_cds(F.col("seq"), True), seq) is prok


def test_reverse_complement(spark):
    assert of_seq(spark, sequences.reverse_complement(F.col("seq")), "AACCG") == "CGGTT"
    rng = random.Random(0)
    for _ in range(5):
        seq = "".join(rng.choice("ACGTNRYKMBDHVSW") for _ in range(50))
        assert of_seq(spark, sequences.reverse_complement(sequences.reverse_complement(F.col("seq"))), seq) == seq


@pytest.mark.parametrize(("start", "end", "frame", "orf"), [(2, 9, 1, "ACCGGT"), (9, 2, -1, "TAACCG"), (2, 10, -2, "GTAACCGGT")])
def test_orf_slices(spark, start, end, frame, orf):
    got = one(spark, sequences.orf_slice(*map(F.col, ("seq", "a", "b", "f"))), "seq string, a int, b int, f int", "AACCGGTTAC", start, end, frame)
    assert got == orf


@pytest.mark.parametrize(("rf", "orf"), [(1, "AACCGGTTA"), (2, "ACCGGTTAC"), (5, "CGTAACCGG"[0:9])])
def test_profile_slices(spark, rf, orf):
    got = one(spark, sequences.profile_orf_slice(*map(F.col, ("seq", "a", "b", "f"))), "seq string, a int, b int, f int", "AACCGGTTACGT", 1, 3, rf)
    begin = 1 * 3 - (4 - rf if rf < 4 else 7 - rf)
    text = "AACCGGTTACGT" if rf < 4 else "ACGTAACCGGTT"
    assert got == text[max(0, begin) : 9 + (rf - 1 if rf < 4 else rf - 4)]
    assert got.startswith(orf[:6]) or orf[:6] in text


def test_translation(spark):
    t = lambda s, **k: of_seq(spark, sequences.translated(F.col("seq"), **k), s)
    assert t("ATGGCCTAATGA") == "MA" and t("ATGTAAGCC") == "M*A" and t("ATGNNNAT") == "MX" and t("") == ""
    assert t("TAATGA", code=6) == "Q" and t("TGA", code=4) == "W" and t("TAA", strip_stops=False) == "*"
    assert all(len(c) == 64 for c in sequences.GENETIC_CODES.values())


def test_frames(spark):
    got = [of_seq(spark, sequences.frame(F.col("seq"), n), "AACCGT") for n in range(1, 7)]
    assert got == ["AACCGT", "ACCGT", "CCGT", "ACGGTT", "CGGTT", "GGTT"]


def test_kmers(spark):
    assert of_seq(spark, sequences.kmers(F.col("seq"), 3), "ABCDE") == ["ABC", "BCD", "CDE"]
    assert of_seq(spark, sequences.kmers(F.col("seq"), 2, 2), "ABCDE") == ["AB", "CD"] and of_seq(spark, sequences.kmers(F.col("seq"), 9), "ABC") == []


def test_names(spark):
    n = lambda c, v: one(spark, c, "n string", v)
    assert n(names.taxon_of(F.col("n")), "T|x|1|OG1") == "T" and n(names.og_of(F.col("n")), "T|x|1|OG1") == "OG1"
    assert n(names.without_og(F.col("n")), "T|x|1|OG1") == "T|x|1" and n(names.sequence_prefix(F.col("n")), "T|x|1|OG1") == "T|x"
    assert n(names.display_id(F.lit("T|u"), F.col("n"), F.lit("c")), "i") == "T|c|u|c|i" and n(names.display_id(F.lit("T"), F.col("n")), "i") == "T|i"
    assert n(names.with_og(F.col("n"), F.lit("OG1")), "a") == "a|OG1" and n(names.with_og(F.col("n"), F.lit("OG1"), "_"), "a") == "a_|OG1"


@pytest.mark.parametrize(
    ("header", "want"),
    [
        ("lcl|1 [locus_tag=L1] [gene=g] [protein_id=P]", ("L1", "P")),
        ("lcl|1 [gene=g] [protein_id=P]", ("g", "P")),
        ("lcl|1 [protein_id=P]", (None, "P")),
        ("lcl|1", (None, None)),
    ],
)
def test_header_tags(spark, header, want):
    row = spark.createDataFrame([(header,)], "h string").select(names.locus_of(F.col("h")), names.tag(F.col("h"), "protein_id")).first()
    assert tuple(row) == want


def test_coverage(spark):
    c = lambda v: one(spark, sequences.coverage_of(F.col("n")), "n string", v)
    assert c("NODE_1_cov_3.14159_x") == 3.14159 and c("T|x_Cov_2.50") == 2.5 and c("plain") is None and c("a_cov_zz") is None


def test_six_frames_are_the_translated_frames(spark):
    seqs = ["ATGGCCTAATGAN", "acgtacgtnnRYacg", "", "AC", None, "ATG\u00e9CCTAG", "TTA" * 5 + "C"]
    frame = spark.createDataFrame([(s,) for s in seqs], "seq string")
    apart = frame.select(*(sequences.translated(sequences.frame(F.col("seq"), n)).alias(f"f{n}") for n in range(1, 7))).collect()
    got = [r["f"] for r in frame.select(sequences.six_translated(F.col("seq")).alias("f")).collect()]
    assert got == [None if s is None else list(r) for s, r in zip(seqs, apart, strict=True)]
    assert got[0][0] == "MA"


def test_letters_of_texts_are_those_of_the_expression(spark):
    from seqloom.plans import substrate

    texts = ["Abc, xyz! 12", "\u0130\u212a\u00dfQ\u00e9\n\tz\U0001f600w", "", None, "\x00a\x7fb"]
    plain = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), substrate.LETTERS, substrate.AA_TARGET)
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(substrate.sequence_of(F.col("text"), substrate.AA_TARGET).alias("a"), plain.alias("b"))
    assert "regexp" not in frame.select("a")._jdf.queryExecution().optimizedPlan().toString()
    assert [r["a"] for r in frame.collect()] == [r["b"] for r in frame.collect()]


def test_composition_is_that_of_the_expressions(spark):
    seqs = ["ATGGCCTAATGAN", "acgtacgtnnRYacg", "", "AC", None, "ATG\u00e9CCTAG", "TCACTGGGATAC" * 5 + "C"]
    frame = spark.createDataFrame([(s,) for s in seqs], "seq string")
    for code in (1, 6):
        plain = frame.select(*(c.alias(n) for n, c in sequences.gc_by_place(F.col("seq"), code).items())).collect()
        assert [r["f"] for r in frame.select(sequences.composition(F.col("seq"), code).alias("f")).collect()] == plain


def test_codons_of_groups_are_summed_within_tasks(spark):
    from seqloom.operators import statistics

    rows = [(f"t{k % 3}", ["ATGGCCTAATGAN", "acgACG", "", None, "ATG\u00e9CCTAG"][k % 5]) for k in range(60)]
    frame = spark.createDataFrame(rows, "taxon string, seq string")
    found = statistics.codon_sums(frame, "taxon")
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    plain = frame.select("taxon", F.explode(sequences.codons(F.col("seq"))).alias("codon")).where("codon rlike '^[ACGT]{3}$'").groupBy("taxon", "codon").count()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
