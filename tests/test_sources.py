"""Readers, writers and the modules over small files."""

import dataclasses
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import reports, statistics, text_mining, trees
from seqloom.plans import modules
from seqloom.sources import sinks, text_formats as tf
from seqloom.streaming import ingest


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fasta(spark, tmp_path):
    path = put(tmp_path / "OG1.x.fa", ">a|1 first one\nACG\nTT\n>b|2\nGG\n\n>c\n")
    rows = tf.read_fasta(spark, path).orderBy("ord").collect()
    assert [(r["id"], r["description"], r["seq"]) for r in rows] == [("a|1", "a|1 first one", "ACGTT"), ("b|2", "b|2", "GG"), ("c", "c", "")]
    assert {r["og"] for r in tf.read_family_files(spark, path).collect()} == {"OG1"}
    out = str(tmp_path / "out")
    sinks.write_fasta(tf.read_fasta(spark, path).where("seq != ''"), out)
    assert {(r["id"], r["seq"]) for r in tf.read_fasta(spark, out).collect()} == {("a|1", "ACGTT"), ("b|2", "GG")}
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_fasta(tf.read_fasta(spark, path), out)
    sinks.write_fasta(tf.read_fasta(spark, path), out, mode="ignore")


def plain_fasta(text):
    """(header, sequence) of each record, line by line."""
    found = []
    for line in text.replace("\r\n", "\n").split("\n"):
        if line.startswith(">"):
            found.append([line[1:].strip(), ""])
        elif found:
            found[-1][1] += "".join(line.split())
    return [tuple(x) for x in found]


@pytest.fixture
def odd_files(tmp_path):
    """Files whose headers hold the mark, of LF and CRLF lines, with records of none to many letters."""
    rng = random.Random(5)
    files = {}
    for name in ("a", "b", "c"):
        nl = "\r\n" if name == "b" else "\n"
        records = []
        for k in range(300):
            head = f"{name}{k} " + rng.choice(["cds [location=<1..>200]", "s2 a->b", "x>y>", "plain", ">"])
            size = rng.choice([0, 1, 5, 60, 400])
            seq = "".join(rng.choice("ACGT") for _ in range(size))
            records.append(f">{head}{nl}" + "".join(seq[i : i + 50] + nl for i in range(0, size, 50)) + rng.choice(["", nl]))
        files[name] = ("" if name != "c" else "; a comment\n\n") + "".join(records)
        (tmp_path / f"{name}.fa").write_bytes(files[name].encode())
    return str(tmp_path), files


@pytest.mark.parametrize("split", [37, 64, 100, 1001, 4096, 10**8])
def test_fasta_equals_a_plain_parser_however_it_is_split(spark, odd_files, split):
    folder, files = odd_files
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        rows = tf.read_fasta(spark, folder).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, text in files.items():
        mine = sorted((r for r in rows if r["source_file"].endswith(f"/{name}.fa")), key=lambda r: r["ord"])
        assert len({r["ord"] for r in mine}) == len(mine)
        assert [(r["description"], r["seq"]) for r in mine] == plain_fasta(text)


def test_genbank(spark, tmp_path):
    path = put(tmp_path / "g.fna", ">lcl|x [locus_tag=L1] [protein_id=P1]\nATG\nTAA\n>lcl|y [gene=g] [note=a]\nATGC\n")
    rows = tf.read_genbank_cds(spark, path).orderBy("ord").collect()
    assert [(r["locus"], r["protein"], r["seq"]) for r in rows] == [("L1", "P1", "ATGTAA"), ("g", None, "ATGC")]
    path = put(tmp_path / "p.fna", ">lcl|x [locus_tag=L1] [note=see >lcl|y] [location=<1..>200]\r\nATG\r\nTAA\r\n>lcl|z [gene=g]\r\nATGC\r\n")
    rows = tf.read_genbank_cds(spark, path).orderBy("ord").collect()
    assert [(r["locus"], r["seq"]) for r in rows] == [("L1", "ATGTAA"), ("g", "ATGC")]


def test_hits_and_profiles(spark, tmp_path):
    path = put(tmp_path / "h.tsv", "q\ts|OG1\t10\t99.5\t1\t30\t1\t10\t1e-20\t55.5\t-1\n")
    row = tf.read_hits(spark, path).first()
    assert (row["qframe"], row["evalue"], row["sseqid"]) == (-1, 1e-20, "s|OG1")
    assert "qframe" not in tf.read_hits(spark, path, proteins=True).columns
    table = put(tmp_path / "t.tbl", "# head\n# more\nr1|RF2  -  OG7 -  1e-9  40.2  x\n# end\n")
    places = put(tmp_path / "p.sto", "# STOCKHOLM 1.0\n#=GS r1|RF2/1-3 DE x\n#=GS r1|RF2/2-9 DE x\nr1|RF2/2-9 AAA\n")
    row = tf.read_profile_hits(spark, table, places).first()
    assert (row["target"], row["profile"], row["score"], row["from_aa"], row["to_aa"]) == ("r1|RF2", "OG7", 40.2, 2, 9)
    gff = put(tmp_path / "r.gff", "##gff\nT|x\tb\trRNA\t1\t9\nplain\tb\trRNA\t1\t9\n")
    assert [r["id"] for r in tf.read_rrna(spark, gff).collect()] == ["T|x"]


def test_alignment_report(spark, tmp_path):
    hsp = "<Hsp><Hsp_query-from>{}</Hsp_query-from><Hsp_query-to>9</Hsp_query-to><Hsp_query-frame>1</Hsp_query-frame><Hsp_qseq>MK</Hsp_qseq><Hsp_hseq>ML</Hsp_hseq></Hsp>"
    hit = "<Hit><Hit_id>h</Hit_id><Hit_hsps>{}</Hit_hsps></Hit>"
    text = "<B><Iteration><Iteration_query-def>q1 more</Iteration_query-def><Iteration_hits>" + hit.format(hsp.format(4) + hsp.format(7)) + hit.format(hsp.format(1)) + "</Iteration_hits></Iteration>"
    text += "<Iteration><Iteration_query-def>q2</Iteration_query-def><Iteration_hits></Iteration_hits></Iteration></B>"
    rows = tf.read_alignments(spark, put(tmp_path / "a.xml", text)).collect()
    assert [tuple(r) for r in rows] == [("q1", 4, 9, 1, "MK", "ML")]


def test_trees_lists_and_taxonomy(spark, tmp_path):
    put(tmp_path / "OG5.x.nwk", "((A|1|g:1,B|2|g:1):1,(C|3|g:1,D|4|g:2):1);")
    nodes = trees.from_newick(tf.read_trees(spark, str(tmp_path / "*.nwk")))
    assert nodes.where("is_leaf").count() == 4 and {r["tree_id"] for r in nodes.collect()} == {"OG5"}
    sinks.write_trees(nodes, str(tmp_path / "trees"))
    (file,) = glob.glob(f"{tmp_path}/trees/tree_id=OG5/part*")
    assert sorted(x.name for x in trees.parse_newick(open(file).read().strip()).leaves()) == ["A|1|g", "B|2|g", "C|3|g", "D|4|g"]
    assert {r["name"] for r in tf.read_list(spark, put(tmp_path / "l.txt", "a\n\n b \n")).collect()} == {"a", "b"}
    n = put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tsuperkingdom\t|\n")
    m = put(tmp_path / "names.dmp", "2\t|\tBacteria\t|\t\t|\tscientific name\t|\n2\t|\teubacteria\t|\t\t|\tsynonym\t|\n1\t|\troot\t|\t\t|\tscientific name\t|\n")
    assert sorted(tuple(r) for r in tf.read_taxonomy(spark, n, m).fillna(-1).collect()) == [(1, -1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria")]


def test_six_frames_and_tables(spark, tmp_path):
    frame = spark.createDataFrame([("a", "ATGGCC")], "id string, seq string")
    sinks.write_six_frames(frame, str(tmp_path / "f"))
    assert {r["id"]: r["seq"] for r in tf.read_fasta(spark, str(tmp_path / "f")).collect()}["a|RF1"] == "MA"
    sinks.write_table(frame, str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").csv(str(tmp_path / "t"), header=True).collect() == frame.collect()
    sinks.write_family_files(frame.withColumn("og", F.lit("g")), str(tmp_path / "o"))
    assert os.path.isdir(tmp_path / "o" / "og=g")


LINEAGES = [("Tax", "Eukaryota", "SAR", "Stram", "x"), ("Bac", "Bacteria", "Prot", "Gam", "y"), ("Euk", "Eukaryota", "Opisthokonta", "Metazoa", "z"), ("Dis", "Eukaryota", "Discoba", "Eug", "w")]


@pytest.fixture
def lineages(spark):
    return spark.createDataFrame(LINEAGES, "taxon string, domain string, supergroup string, major string, minor string")


def test_add_taxa_from_transcripts(spark):
    seqs = [("n1_cov_2.5", 0, "A" * 100 + "ATGGCC" * 30), ("short", 1, "ATG"), ("r", 2, "G" * 250), ("plus", 3, "C" * 100 + "ATGGCC" * 30)]
    data = spark.createDataFrame(seqs, "id string, ord long, seq string")
    ids = ["Tax_n|Transcript_1_Length_280_Cov_2.50", "Tax_n|Transcript_2_Length_250", "Tax_n|Transcript_3_Length_280"]
    hit = lambda q, n: (q, "ref|OG1", 60, 99.0, 101, 280, 1, 60, 1e-30, 50.0, 1, n)
    table = spark.createDataFrame([hit(ids[0], 0), hit(ids[2], 1)], tf.HIT_COLUMNS + ", ord long")
    rrna = [spark.createDataFrame([(ids[1],)], "id string")]
    subjects = spark.createDataFrame([("ref|OG1", 60)], "id string, length int")
    out = modules.add_taxa(data, table, modules.AddTaxa(taxon="Tax n.", kind="transcripts"), rrna, subjects=subjects)
    assert {r["Updated_Name"] for r in out["names"].collect()} == set(ids) and [r["id"] for r in out["rrna"].collect()] == [ids[1]]
    assert [(r["id"], r["og"], r["seq"]) for r in out["proteins"].collect()] == [(ids[0] + "|OG1", "OG1", "MA" * 30)]
    assert out["redundant"].count() == 2 and out["statistics"].first()["coverage"] == 2.5


def test_add_taxa_thresholds_names_and_ties(spark):
    data = spark.createDataFrame([(f"n{k}", k, "C" * 30 + "ATGGCC" * 40) for k in (5, 3, 9)], "id string, ord long, seq string")
    ids = [f"Tax_c_Transcript_{k}_Length_270" for k in (1, 2, 3)]
    hit = lambda q, n: (q, "ref|OG1", 80, 99.0, 31, 270, 1, 80, 1e-30, 50.0, 1, n)
    table = spark.createDataFrame([hit(q, 10 - n) for n, q in enumerate(ids)], tf.HIT_COLUMNS + ", ord long")
    options = modules.AddTaxa(taxon="Tax", code="c", delim="_", kind="transcripts", only_top_hit=True, stats=False)
    with pytest.raises(ValueError, match="subject_cover"):
        modules.add_taxa(data, table, options)
    of = lambda length, **more: modules.add_taxa(data, table, dataclasses.replace(options, **more), subjects=spark.createDataFrame([("ref|OG1", length)], "id string, length int"))
    assert of(200)["proteins"].count() == 0 and of(80, query_cover=95.0)["proteins"].count() == 0
    out = of(80, query_cover=80.0)
    assert {r["Initial_ID"]: r["Updated_Name"] for r in out["names"].collect()} == dict(zip(("n3", "n5", "n9"), ids))
    assert [r["id"] for r in out["proteins"].collect()] == [ids[0] + "_|OG1"]  # the first record of those that tie


def test_add_taxa_from_coding_sequences(spark):
    data = spark.createDataFrame([("h", "L1", "P1", 0, "ATGGCCTAA"), ("h", "L1", "P2", 1, "ATGGCCGCCTAA"), ("h", "L2", "P3", 2, "ATGGC")], "header string, locus string, protein string, ord long, seq string")
    table = spark.createDataFrame([("T|c|P2", "ref|OG9", 3, 99.0, 1, 3, 1, 3, 1e-30, 50.0, 1, 0)], tf.HIT_COLUMNS + ", ord long")
    out = modules.add_taxa(data, table, modules.AddTaxa(taxon="T", code="c", kind="genbank", subject_cover=0.0))
    assert [(r["id"], r["seq"]) for r in out["proteins"].collect()] == [("T|c|P2|OG9", "MAA")]
    plain = spark.createDataFrame([("x|P7", 0, "GTGGCCTGA"), ("x|P8", 1, "GTGGCCTG")], "id string, ord long, seq string")
    table = table.withColumn("qseqid", F.lit("T|P7"))
    out = modules.add_taxa(plain, table, modules.AddTaxa(taxon="T", kind="orfs", only_top_hit=True, stats=False, subject_cover=0.0), lineage=["Bacteria"])
    assert [(r["id"], r["seq"]) for r in out["proteins"].collect()] == [("T|P7|OG9", "VA")] and "statistics" not in out


def test_options_are_checked(spark):
    with pytest.raises(ValueError, match="taxon"):
        modules.check("add_taxa", modules.AddTaxa())
    with pytest.raises(ValueError, match="code"):
        modules.check("add_taxa", modules.AddTaxa(taxon="T", gen_code=99))
    with pytest.raises(ValueError, match="negative"):
        modules.check("contam", modules.Contam(taxon="T", cluster_threshold=-1.0))


def test_contam_by_kmers(spark, lineages):
    import random

    rng = random.Random(1)
    kinds = {x: "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(80)) for x in ("Bac", "Euk")}
    change = lambda s: "".join(rng.choice("ACDE") if rng.random() < 0.03 else c for c in s)
    refs = [(f"{x}|r{k}|OG1", "OG1", change(s)) for x, s in kinds.items() for k in range(12)]
    queries = [("Tax|q1|OG1", "OG1", change(kinds["Bac"])), ("Tax|q2|OG1", "OG1", change(kinds["Euk"]))]
    frame = lambda rows: spark.createDataFrame(rows, "id string, og string, seq string")
    out = modules.contam_by_kmers(frame(queries), frame([*refs, ("Bac|z|OG2", "OG2", "A" * 40)]), lineages, modules.Contam(taxon="Tax", ngrams=2))
    found = {(r["query_seq"], r["domain"]) for r in out["detail"].collect()}
    assert ("Tax|q1|OG1", "Bacteria") in found and ("Tax|q2|OG1", "Bacteria") not in found
    assert out["top_taxa"].count() >= 1 and out["domains"].count() >= 1


NEWICK = "(((Tax|a|1|OG1:0.1,Bac|b|1|OG1:0.1):1,(Bac|c|1|OG1:0.1,Bac|d|1|OG1:0.1):1):1,((Euk|e|1|OG1:0.1,Tax|f|1|OG1:0.1):1,(Euk|g|1|OG1:0.1,Dis|h|1|OG1:3):1):1);"


def test_reports_have_the_columns_of_the_files(spark, lineages, tmp_path):
    text = spark.createDataFrame([("OG1", NEWICK)], "tree_id string, newick string")
    out = modules.contam_by_trees(text, lineages, modules.Contam(taxon="Tax"))
    sinks.write_report(out["detail"], str(tmp_path / "d"), "tree_detail", "average")
    rows = {r["Taxon_Sequence"]: r for r in spark.read.option("sep", "\t").csv(str(tmp_path / "d"), header=True).collect()}
    first = rows["Tax|a|1|OG1"]
    assert list(first.asDict()) == "Taxon Taxon_Sequence Gene_Family Domain Major_Group Major_Clade Minor_Clade Num_Sister_Taxa Sister_Taxa Sister_Sequences Branch_Length Average_Branch_Length Branch_Length_Evaluation".split()
    assert (first["Gene_Family"], first["Domain"], first["Sister_Taxa"], first["Sister_Sequences"], first["Branch_Length_Evaluation"]) == ("OG1", "Bacteria", "Bac", "Bac|b|1|OG1", "short")
    found = modules.select_orthologs(text, lineages, modules.Contam(taxon="Tax"))
    assert reports.as_report(found["detail"], "ortholog_detail").columns[0] == "Sequence" and reports.as_report(found["selected"], "orthologs").columns == ["Sequence", "Sister_Taxa"]
    data = spark.createDataFrame([("x|P7", 0, "GTGGCCTGA")], "id string, ord long, seq string")
    table = spark.createDataFrame([("T|P7", "ref|OG9", 3, 99.0, 1, 3, 1, 3, 1e-30, 50.0, 1, 0)], tf.HIT_COLUMNS + ", ord long")
    added = modules.add_taxa(data, table, modules.AddTaxa(taxon="T", kind="orfs", subject_cover=0.0))
    assert reports.as_report(added["statistics"], "statistics").columns == "Sequence Length GC-Content GC1 GC2 GC3 GC12 GC3-4-Fold-Degen Expected-ENc ENc".split()
    assert reports.as_report(added["names"], "names").collect() == [("x|P7", "T|P7")]
    codes = modules.predict_genetic_code(spark.createDataFrame([("a", "ATG")], "id string, seq string"), spark.createDataFrame([("a", 1, 3, 1, "M", "M")], "id string, q_from int, q_to int, q_frame int, q_seq string, h_seq string"))
    assert reports.as_report(codes, "genetic_code").where("Codon = 'ATG'").first()["Predicted-Amino-Acid"] == "M"
    stops = statistics.stop_rates(data)
    assert reports.as_report(stops, "stops").columns == "Stop_Codon Counts Total_Codons Frequency_per_1k_Codons".split()
    members = spark.createDataFrame([("a", "q|1", "E", "S", "M", "N"), ("a", "x|2", "E", "S", "M", "N"), ("a", "y|2", "E", "S", "M", "N")], "cluster string, id string, domain string, supergroup string, major string, minor string")
    assert reports.as_report(text_mining.by_catch(members, "q|"), "kmer_detail").columns == "Query_Seq Domain Major_Group Major_Clade Minor_Clade Cluster_Seq Cluster_Taxon".split()


def test_contam_by_trees_and_orthologs(spark, lineages):
    text = spark.createDataFrame([("OG1", NEWICK), ("OG2", "(Bac|a|1|OG2:1,Bac|b|1|OG2:1);")], "tree_id string, newick string")
    out = modules.contam_by_trees(text, lineages, modules.Contam(taxon="Tax"))
    detail = {r["sequence"]: r for r in out["detail"].collect()}
    assert set(detail) == {"Tax|a|1|OG1", "Tax|f|1|OG1"}
    assert detail["Tax|a|1|OG1"]["domain"] == "Bacteria" and detail["Tax|a|1|OG1"]["sister_taxa"] == "Bac" and detail["Tax|f|1|OG1"]["supergroup"] == "Opisthokonta"
    assert detail["Tax|a|1|OG1"]["verdict"] == "short" and [r["frequency"] for r in out["single_sisters"].collect()] == [1, 1]
    picked = modules.select_orthologs(text, lineages, modules.Contam(taxon="Tax"))
    # c and d have only each other beside them, so b has most sister taxa; e and g tie but for their names.
    assert {r["taxon"]: r["sequence"] for r in picked["selected"].collect()} == {"Tax": "Tax|f|1|OG1", "Bac": "Bac|b|1|OG1", "Euk": "Euk|e|1|OG1", "Dis": "Dis|h|1|OG1"}
    same = {r["sequence"] for r in picked["detail"].collect() if r["same_domain"] == "same"}
    assert same == {"Tax|f|1|OG1", "Euk|e|1|OG1", "Euk|g|1|OG1", "Dis|h|1|OG1"} and picked["detail"].count() == 8


def test_family_filters(spark):
    rows = [("OG1", f"T{k}|x|OG1", "ACDEFGHIKLMNPQRSTVWY"[:15] + "ACDEF"[k % 5]) for k in range(10)] + [("OG1", "T0|odd|OG1", "WWWWWWWWWWWWWWW"), ("OG1", "T1|stop|OG1", "AC*EFGHIKLMNPQR"), ("OG2", "T1|z|OG2", "AAAA")]
    data = spark.createDataFrame(rows, "og string, id string, seq string")
    for kind in ("zscore", "bootstrap", "iqr"):
        out = modules.filter_families(data, modules.FilterFamilies(similarity=kind, threshold=2.0))
        assert {r["id"] for r in out["kept"].collect()} == {f"T{k}|x|OG1" for k in range(10)}
    taxa = spark.createDataFrame([(f"T{k}",) for k in range(1, 6)], "name string")
    assert modules.filter_families(data, modules.FilterFamilies(similarity=None), taxa).get("by_similarity") is None
    assert modules.filter_families(data, modules.FilterFamilies(similarity=None), taxa)["kept"].count() == 5


def test_stream_takes_each_file_once(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    put(tmp_path / "in" / "a.fa", ">T|1|OG1 x\nAC\nGT\n>T|2|OG2\nA\n")
    run = lambda: ingest.append_to(ingest.new_records(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    run()
    put(tmp_path / "in" / "b.fa", ">U|3|OG1\nTT\n")
    run()
    run()
    rows = spark.read.parquet(str(tmp_path / "t")).orderBy("id").collect()
    assert [(r["id"], r["taxon"], r["og"], r["seq"]) for r in rows] == [("T|1|OG1", "T", "OG1", "ACGT"), ("T|2|OG2", "T", "OG2", "A"), ("U|3|OG1", "U", "OG1", "TT")]
