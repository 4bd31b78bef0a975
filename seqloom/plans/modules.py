"""The modules as functions: inputs are DataFrames (or paths of the sources), results are named DataFrames.

Hits, profile hits and trees come from the library's own searches (operators search, profiles, placing) or from files that
other programs have written.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, functions as F

from ..functions import names, sequences
from ..operators import collapse, families, genetic_code, hits, records, reports, statistics, taxonomy, text_mining, trees


@dataclass
class AddTaxa:
    """Options of add_taxa."""

    taxon: str = ""
    code: str | None = None
    kind: str = "guess"  # transcripts, orfs, genbank or guess
    min_length: int = 200
    evalue: float = 1e-10
    min_identity: float = 0.0
    max_hits: int = 1
    subject_cover: float = 60.0
    query_cover: float = 0.0
    delim: str = "|"
    og_delim: str = "|"
    gen_code: int = 1
    only_top_hit: bool = False
    all_isoforms: bool = False
    null_locus: str = "collapse"
    best: str = "last"
    identity: float = 0.97
    stats: bool = True


@dataclass
class Contam:
    """Options of contam."""

    taxon: str = ""
    cluster_threshold: float = 3.0
    eval_threshold: float = 0.6
    kmer: int = 5
    ngrams: int = 5
    least_df: int = 5
    neighbours: int = 10
    blen_mode: str = "median"


@dataclass
class FilterFamilies:
    """Options of filter_families."""

    min_prop: float = 0.33
    max_prop: float = 2.0
    centre: str = "median"
    similarity: str | None = "zscore"  # zscore, bootstrap, bootstrap_lof, iqr or None
    kmer: bool = False
    threshold: float = 3.0
    rounds: int = 100
    sample: int = 100


REQUIRED = {"add_taxa": ("taxon",), "contam": ("taxon",), "filter_families": ()}


def check(name: str, options) -> None:
    """Raises ValueError for required options that are missing and for values out of their range."""
    missing = [x for x in REQUIRED[name] if not getattr(options, x)]
    if missing:
        raise ValueError(f"{name} needs {', '.join(missing)}")
    for f in fields(options):
        value = getattr(options, f.name)
        if f.type in ("int", "float") and isinstance(value, (int, float)) and not isinstance(value, bool) and value < 0:
            raise ValueError(f"{f.name} must not be negative")
    if name == "add_taxa" and options.gen_code not in sequences.CODES:
        raise ValueError(f"genetic code {options.gen_code} isn't known; known: {sorted(sequences.CODES)}")
    if name == "add_taxa" and options.kind not in ("guess", "transcripts", "orfs", "genbank"):
        raise ValueError(f"kind {options.kind} isn't known")


def taxon_name(words: str) -> str:
    """A taxon's name as it stands in ids: its words joined with _, without points."""
    return "_".join(words.replace(".", "").split())


def add_taxa(data: DataFrame, hit_table: DataFrame, options: AddTaxa, rrna: list[DataFrame] | None = None, lineage: list[str] | None = None, subjects: DataFrame | None = None) -> dict[str, DataFrame]:
    """Sequences of a new taxon, named, cut to their reading frames and assigned to gene families.

    data: records (id, ord, seq) or, for genbank, (header, locus, protein, ord, seq). hit_table: hits of the renamed
    nucleotides (transcripts) or proteins. subjects: id and length of the sequences that were hit, for thresholds of
    coverage that hit_table has no columns for. lineage tells whether the taxon is a prokaryote, which changes starts and code.
    """
    check("add_taxa", options)
    taxon, out = F.lit(taxon_name(options.taxon)), {}
    prokaryote = bool(lineage) and lineage[0] in ("Bacteria", "Archaea")
    code = 11 if prokaryote else options.gen_code
    kind = options.kind
    if kind == "guess":
        kind = "transcripts" if statistics.looks_like_transcripts(data, code) else "orfs"
    label = F.lit(options.code) if options.code else None

    def kept_hits(queries: DataFrame) -> DataFrame:
        found = hits.covered(hit_table, queries, subjects, options.subject_cover, options.query_cover)
        return hits.one_hit(hits.keep_hits(found, options.evalue, options.min_identity, options.max_hits, options.subject_cover, options.query_cover), options.best)

    if kind == "transcripts":
        named = records.renumber(records.keep_long(data, options.min_length), taxon, code=label, delim=options.delim)
        out["names"] = records.name_table(named)
        clean = named.drop("id").withColumnRenamed("new_id", "id")
        if rrna:
            out["rrna"], clean = records.split_by_hits(clean, rrna)
        orfs = hits.slice_orfs(clean, kept_hits(clean), options.delim, options.og_delim).where(F.length("orf") > 0)
        if options.only_top_hit:
            orfs = hits.best_in_family(orfs)
        final = orfs.select(F.col("new_id").alias("id"), "og", F.col("orf").alias("seq"))
        folded = collapse.collapse(final, options.identity)
        final = final.join(folded.where("id = kept_id").select("id"), "id", "left_semi")
        out["redundant"] = folded
    else:
        if kind == "genbank":
            whole = records.keep_complete(data, prokaryote)
            chosen = whole.where("protein is not null") if options.all_isoforms else records.longest_isoform(whole, options.null_locus)
            named = chosen.withColumn("id", F.col("protein")).withColumn("new_id", names.display_id(taxon, F.col("protein"), label, options.delim))
        else:
            last = F.element_at(F.split("id", names._quoted(options.delim)), -1)
            named = records.keep_in_frame(data).withColumn("new_id", names.display_id(taxon, last, label, options.delim))
        out["names"] = records.name_table(named)
        clean = named.drop("id").withColumnRenamed("new_id", "id").select("id", "ord", "seq")
        proteins = clean.withColumn("seq", F.substring("seq", F.lit(1), F.floor(F.length("seq") / 3).cast("int")))  # as long as its protein
        scored = clean.join(kept_hits(proteins).select("qseqid", "sseqid", "bitscore"), F.col("id") == F.col("qseqid")).withColumn("og", names.og_of(F.col("sseqid"), options.og_delim))
        if options.only_top_hit:
            scored = hits.best_in_family(scored.select("og", "id", "ord", "seq", "bitscore"))
        final = scored.select(names.with_og(F.col("id"), F.col("og"), options.delim, options.og_delim).alias("id"), "og", "seq")
    out["nucleotides"] = final
    out["proteins"] = final.withColumn("seq", sequences.translated(F.col("seq"), code))
    if options.stats:
        out["statistics"] = statistics.gc_table(final, code).join(statistics.observed_enc(final, code).groupBy("id").agg(F.max("enc").alias("enc")), "id", "left")
    return out


def contam_by_kmers(queries: DataFrame, references: DataFrame, lineages: DataFrame, options: Contam) -> dict[str, DataFrame]:
    """By-catch in a taxon's peptides, by clusters of k-mer neighbours: a detail table and its summaries.

    queries, references: id (taxon|..|OG), og, seq. lineages: taxon and its four levels.
    """
    check("contam", options)
    both = records.with_family_data(references.select("id", "og", "seq"), queries.select("id", "og", "seq")).where(F.length("seq") >= options.kmer)
    weights = text_mining.tfidf(both, options.kmer, options.ngrams, options.least_df)
    edges = text_mining.text_neighbours(weights, both, options.neighbours)
    clusters = text_mining.clusters_of_graph(edges, both, options.cluster_threshold)
    unknown = {x: F.coalesce(x, F.lit("Unknown")) for x in taxonomy.LEVELS}
    members = clusters.withColumn("cluster", F.concat_ws("#", "og", F.col("cluster").cast("string"))).withColumn("taxon", names.taxon_of(F.col("id"))).join(F.broadcast(lineages), "taxon", "left").withColumns(unknown)
    detail = text_mining.by_catch(members, taxon_name(options.taxon), options.eval_threshold)
    clear = detail.where("major != 'No-clear-major-clade'")
    return {
        "detail": detail,
        "domains": reports.distinct_query_frequency(detail, ["domain", "supergroup"]),
        "groups": reports.distinct_query_frequency(clear, ["supergroup", "major"]),
        "clades": reports.distinct_query_frequency(clear, ["supergroup", "major", "minor"]),
        "top_taxa": reports.top(detail, "cluster_taxon"),
        "top_groups": reports.top(detail, "supergroup"),
        "top_clades": reports.top(clear, "major"),
    }


def contam_by_trees(newick: DataFrame, lineages: DataFrame, options: Contam, every: bool = False) -> dict[str, DataFrame]:
    """By-catch in a taxon's leaves of gene trees, by their sisters: the rooted trees, a detail table and its summaries.

    every: the leaves of all taxa instead.
    """
    if not every:
        check("contam", options)
    nodes = trees.from_newick(newick, lineages)
    nodes = nodes.withColumn("taxon", F.when(F.col("is_leaf"), names.taxon_of(F.col("name"))))
    forest = trees.Forest(nodes)
    leaves = nodes.where("is_leaf").withColumn("prefix", names.sequence_prefix(F.col("name")))
    wanted = F.lit(True) if every else F.contains("name", F.lit(taxon_name(options.taxon)))
    asked = leaves.where(wanted).select("tree_id", F.col("node_id").alias("leaf"), F.col("name").alias("sequence"), "taxon")
    levels = list(taxonomy.LEVELS)
    named = leaves.select("tree_id", "node_id", "name", "prefix", "taxon").join(F.broadcast(lineages.select("taxon", *levels)), "taxon", "left").withColumns({x: F.coalesce(x, F.lit("Unknown")) for x in levels})
    sisters = trees.Sisters(named, forest)
    agreed = sisters.agreed(levels)
    blanks = dict(zip(levels, ("No-clear-domain", "No-clear-major-group", "No-clear-major-clade", "No-clear-minor-clade"), strict=True))
    verdicts = trees.branch_verdicts(nodes, options.blen_mode).select("tree_id", F.col("node_id").alias("leaf"), F.col("dist").alias("branch_length"), "threshold", "verdict")
    detail = asked.join(agreed, ["tree_id", "leaf"], "left").join(sisters.lists(name="name"), ["tree_id", "leaf"], "left").join(verdicts, ["tree_id", "leaf"])
    detail = detail.withColumns({x: F.coalesce(x, F.lit(b)) for x, b in blanks.items()})
    short = detail.where("verdict = 'short'")
    return {
        "trees": nodes,
        "detail": detail,
        "domains": reports.frequency(detail, ["domain", "supergroup"]),
        "groups": reports.frequency(detail.where("major != 'No-clear-major-clade'"), ["supergroup", "major"]),
        "clades": reports.frequency(detail.where("major != 'No-clear-major-clade'"), ["supergroup", "major", "minor"]),
        "short_groups": reports.frequency(short.where("domain = 'Eukaryota'"), ["supergroup", "major"]),
        "single_sisters": reports.single_sister_top(detail),
        "clade_sizes": trees.clade_sizes(forest, nodes.join(F.broadcast(lineages.select("taxon", "supergroup")), "taxon", "left")),
    }


def predict_genetic_code(nucleotides: DataFrame, alignments: DataFrame) -> DataFrame:
    """The codon table that alignments of a taxon's nucleotides show."""
    return genetic_code.codon_consensus(genetic_code.aligned_codons(nucleotides, alignments))


def filter_families(data: DataFrame, options: FilterFamilies, taxa: DataFrame | None = None, ogs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Gene families (id, og, seq) without stops, of listed taxa and families, near the family's length and without outliers."""
    check("filter_families", options)
    rows = records.keep_without_stops(data).withColumn("taxon", names.taxon_of(F.col("id")))
    if taxa is not None:
        rows = records.listed(rows, taxa, "taxon")
    if ogs is not None:
        rows = records.listed(rows, ogs, "og")
    sized = families.size_filter(rows, options.min_prop, options.max_prop, options.centre)
    first = second = None
    if options.similarity:
        medians = families.row_medians(sized)
        if options.similarity == "iqr":
            scored = families.iqr_outliers(medians, options.threshold)
        elif options.similarity in ("bootstrap", "bootstrap_lof"):
            scored = families.bootstrap_outliers(medians, options.threshold, options.sample, options.rounds)
            if options.similarity == "bootstrap_lof":
                scored = families.lof_of_scores(scored)
        else:
            scored = families.zscore_outliers(medians, options.threshold)
        first = scored.where("outlier").select("og", "id")
    if options.kmer:
        near = families.lof_neighbours(sized, lambda rows, k, _: text_mining.text_neighbours(text_mining.tfidf(rows, longest=4), rows, k), "og")
        second = families.lof(near, "og").where("outlier").select("og", "id")
    out = {"kept": families.combine_filters(sized, first, second), "sized": sized}
    return out | ({"by_similarity": first} if first is not None else {}) | ({"by_kmers": second} if second is not None else {})


def select_orthologs(newick: DataFrame, lineages: DataFrame, options: Contam) -> dict[str, DataFrame]:
    """One sequence of each taxon of each tree: that whose sisters share most of its own taxonomy; and the table it is chosen from."""
    found = contam_by_trees(newick, lineages, options, every=True)
    nodes, detail = found["trees"], found["detail"]
    own = F.broadcast(lineages.select("taxon", *(F.col(x).alias(f"own_{x}") for x in ("domain", "supergroup", "major"))))
    far = trees.Forest(nodes).root_distances().withColumnRenamed("node_id", "leaf")
    same = sum((F.coalesce((F.col(x) == F.col(f"own_{x}")).cast("int"), F.lit(0)) for x in ("domain", "supergroup", "major")), F.lit(0))
    table = detail.join(own, "taxon", "left").join(far, ["tree_id", "leaf"]).withColumn("same", same).withColumn("n_sister_taxa", F.coalesce("n_sister_taxa", F.lit(0)))
    yes = {f"same_{x}": F.when(F.coalesce(F.col(x) == F.col(f"own_{x}"), F.lit(False)), "same").otherwise("diff") for x in ("domain", "supergroup", "major")}
    picked = trees.pick_orthologs(table.withColumn("id", F.col("sequence")), ["tree_id", "taxon"])
    return {
        "detail": table.withColumns(yes).select("tree_id", "sequence", "n_sister_taxa", "branch_length", *yes, "sister_taxa"),
        "selected": picked.select("tree_id", "taxon", "sequence", "sister_taxa"),
    }
