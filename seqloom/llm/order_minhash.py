"""Near-duplicate documents by Order MinHash over word k-mers, verified by banded alignment.

A text is its words in lower case; its k-mers carry the number of their occurrence. Each sketch keeps the four k-mers
least under its own hash, in the order of the text, so two texts share a sketch when those k-mers agree and stand in
the same order. k is two words: where a fifth of the words differ, a third of the k-mers of five words survive and half
of those of two (0.43 of all of both texts where every fifth word is another), so many short ones in order find such pairs and seldom meet where texts only share a passage; short
texts have sketches of fewer k-mers as well (FAMILIES). Distinct texts that share a sketch are compared in three steps:

1. every text of a sketch's bucket is aligned with the bucket's head, the text that meets most others (a star, not all pairs);
2. the aligned pairs give components;
3. in buckets whose texts, but for the head, are in more than one component, texts of different components still have to meet, so a link
   is never lost because it wasn't to the head (within a component nothing is left to find). They meet through rare
   words: of two texts in which at most a fifth of the words differ, the rarest fifth (and one word) of each must share
   a word, in whatever order words are ranked. That loses nothing, and where many texts share a passage, its words
   are common and so rank last. Two texts come together once, by the least rare word that they share, unless the words
   that only one of them has already cost too many edits. Of all texts of a component that a text meets it is aligned
   with the likeliest first; what that doesn't join is aligned in full.

Two texts are linked if their edit distance, in words, is at most a fifth of the longer one's words (similarity 0.8);
texts whose shingles of five words overlap by 0.8 or more, in order, are among them.
Exact copies are one text from the start. The class of a document is the least doc_id that links lead to.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .alignment import distance_within
from .common import blocks, staged
from .components import components

WORD = re.compile(r"\w+")
#: Words of a k-mer, k-mers of a sketch, number of sketches, and how many words a text that has them falls short of (None: any text).
FAMILIES = ((2, 4, 80, None), (2, 3, 40, 64), (2, 2, 40, 16))
SIMILARITY = 0.8
NO_ID = -(1 << 63)
#: Bytes of a text's SHA-256 that tell it from other texts.
DIGEST = 16
CACHED_WORDS = 400_000
#: Words of a text set bits among so many longs; see least_distance.
BAG = 128
#: Word counts, for ranking only, are kept in so many cells; words that meet in one are ranked together.
RANK_CELLS = 1 << 20
#: Words times sketches that are hashed at a time.
CELLS = 1_000_000
#: Rare words up to so many are kept as a list with each of them, so a pair comes up once; of longer texts it may come up again.
LISTED = 200
#: The first band of an alignment, in words.
NARROW = 256


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower()) or text.split()


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser: flips about half of the bits for each flipped bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    """sketch(text): the keys of a text's sketches; none for a text without words."""

    def __init__(self, families: tuple = FAMILIES):
        self.families = families
        rng = np.random.default_rng(20240229)
        odd = lambda n: rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.factors = [odd(sketches) for _, _, sketches, _ in families]
        self.starts = [odd(sketches) for _, _, sketches, _ in families]
        self.places = odd(1 + max(max(k, picks) for k, picks, _, _ in families))
        self.words = WordHashes()

    def __getstate__(self):
        return {"families": self.families}

    def __setstate__(self, state):
        self.__init__(**state)

    def kmers(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the k-mers in order, each with the number of its occurrence."""
        n, k = max(1, len(hashes) - k + 1), min(k, len(hashes))
        grams = np.zeros(n, np.uint64)
        for i in range(k):
            grams += hashes[i : i + n] * self.places[i]
        grams = mixed(grams)
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        if (ordered[1:] == ordered[:-1]).any():
            first = np.r_[True, ordered[1:] != ordered[:-1]]
            begin = np.flatnonzero(first)
            times = np.empty(n, np.uint64)
            times[order] = np.arange(n) - begin[np.cumsum(first) - 1]
            grams += times * self.places[-1]
        return mixed(grams)

    def sketch(self, text: str) -> list[int]:
        words = words_of(text)
        if not words:
            return []
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        keys: list[np.ndarray] = []
        for (k, picks, sketches, below), factors, starts in zip(self.families, self.factors, self.starts, strict=True):
            if below is not None and len(words) >= below:
                continue
            grams = self.kmers(hashes, k)
            step = max(1, CELLS // len(grams))
            for at in range(0, sketches, step):
                key = starts[at : at + step].copy()
                for i, place in enumerate(self.least(grams, factors[at : at + step], min(picks, len(grams)))):
                    key = mixed(key + grams[place] * self.places[i])
                keys.append(key)
        return np.concatenate(keys).view(np.int64).tolist()

    @staticmethod
    def least(grams: np.ndarray, factors: np.ndarray, picks: int) -> np.ndarray:
        """For each factor the places of the k-mers whose hash times the factor is least, as rows in the order of the text."""
        values = np.multiply.outer(factors, grams)
        rows, found = np.arange(len(factors)), []
        for _ in range(picks):
            found.append(values.argmin(1))
            values[rows, found[-1]] = np.uint64(2**64 - 1)
        return np.sort(np.array(found), 0)


def labelled_words(hashes: WordHashes, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, each with the number of its occurrence, so equal multisets have equal sets; and hashes of the
    words with a class of that number, the classes being wider the more often a word has come up."""
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    order = np.argsort(h, kind="stable")
    first = np.r_[True, h[order][1:] != h[order][:-1]]
    times = np.empty(len(h), np.int64)
    times[order] = np.arange(len(h)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    classes = np.where(times < 8, times, 8 + np.floor(8 * np.log2(np.maximum(times, 8) / 8)).astype(np.int64))
    return tuple(mixed(h + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) for n in (times, classes))


def word_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often words come up in texts (id, text, component), and whether in more than one component, by cell.

    RANK_CELLS rows at most reach the driver.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("cell", "n", "lo", "hi")])

    def run(batches):
        total, hashes = np.zeros(RANK_CELLS, np.int64), WordHashes()
        lo, hi = np.full(RANK_CELLS, np.iinfo(np.int64).max), np.full(RANK_CELLS, np.iinfo(np.int64).min)
        for batch in batches:
            for text, component in zip(batch["text"], batch["component"].to_pylist(), strict=True):
                if words := words_of(text.as_py()):
                    cells, n = np.unique(labelled_words(hashes, words)[0] % np.uint64(RANK_CELLS), return_counts=True)
                    cells = cells.astype(np.int64)
                    total[cells] += n
                    lo[cells], hi[cells] = np.minimum(lo[cells], component), np.maximum(hi[cells], component)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells]), pa.array(lo[cells]), pa.array(hi[cells])], schema=schema)

    rows = texts.mapInArrow(run, "cell long, n long, lo long, hi long")
    found = rows.groupBy("cell").agg(F.sum("n").alias("n"), (F.min("lo") != F.max("hi")).alias("met")).toArrow()
    counts, met = np.zeros(RANK_CELLS, np.int64), np.zeros(RANK_CELLS, bool)
    counts[found["cell"].to_numpy()], met[found["cell"].to_numpy()] = found["n"].to_numpy(), found["met"].to_numpy(zero_copy_only=False)
    return counts, met


def rare_words(texts: DataFrame) -> DataFrame:
    """id, component, size, the rarest fifth of the words (and one) and the bits that the words set in BAG longs, of texts
    (id, text, component).

    A word of a text is one occurrence; those that no other component has are left out of the rare ones, and those of one
    class are one, so a word said hundreds of times gives a few of them.
    """
    sent = texts.sparkSession.sparkContext.broadcast(word_counts(texts))
    schema = pa.schema([("id", pa.int64()), ("component", pa.int64()), ("size", pa.int64()), ("rare", pa.list_(pa.int64())), ("bag", pa.list_(pa.int64()))])

    def run(batches):
        hashes, (counts, met) = WordHashes(), sent.value
        for batch in batches:
            rows = zip(batch["id"].to_pylist(), batch["component"].to_pylist(), batch["text"], strict=True)
            while some := list(islice(rows, 256)):
                out = []
                for key, component, text in some:
                    words = words_of(text.as_py())
                    marks, keys = labelled_words(hashes, words) if words else (np.zeros(0, np.uint64),) * 2
                    cells = (marks % np.uint64(RANK_CELLS)).astype(np.int64)
                    least = int(np.ceil(SIMILARITY * len(words) - 1e-9))  # words that a similar text has as well
                    rank = np.lexsort((marks, counts[cells]))[: len(words) - least + 1]
                    bits = np.zeros(BAG * 64, np.uint8)
                    bits[((marks >> np.uint64(40)) % np.uint64(BAG * 64)).astype(np.int64)] = 1
                    out.append((key, component, len(words), np.unique(keys[rank][met[cells[rank]]].view(np.int64)).tolist(), np.packbits(bits, bitorder="little").view("<i8").tolist()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return texts.mapInArrow(run, "id long, component long, size long, rare array<long>, bag array<long>")


def least_distance(x: str, y: str):
    """A lower bound of the edit distance of two texts: each bit that only one of them sets stands for a word that costs an edit."""
    over = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda t, v: t + v)
    return F.coalesce(F.greatest(over(x, y), over(y, x)), F.lit(0))


def across(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between texts of different components that share a bucket. placed: key, id, component, without the heads, which have met all."""
    open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    owners = staged(placed.join(open_keys, "key").select("id", "component").distinct(), "open-texts")
    members = staged(rare_words(staged(texts.join(owners, "id"), "open-words")), "open-members")
    words = members.select("id", "component", F.explode("rare").alias("word"))
    shared = words.groupBy("word").agg(F.min("component").alias("first"), F.max("component").alias("last")).where("first != last").select("word")
    met = staged(words.join(shared, "word").select("word", "id").join(members.withColumn("rare", F.when(F.size("rare") <= LISTED, F.col("rare"))), "id"), "shared-words")
    x, y = (met.select("word", *(F.col(c).alias(f"{c}_{side}") for c in met.columns if c != "word")) for side in "ab")
    longest = F.greatest("size_a", "size_b")
    most = F.floor((1 - SIMILARITY) * longest + 1e-9)
    near = F.least("size_a", "size_b") >= longest * SIMILARITY - 1e-9
    cost = least_distance("bag_a", "bag_b")
    once = F.coalesce(F.array_min(F.array_intersect("rare_a", "rare_b")) == F.col("word"), F.lit(True))
    pairs = x.join(y, "word").where((F.col("component_a") > F.col("component_b")) & near & once & (cost <= most))
    pairs = pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "component_a", "component_b", cost.alias("cost"))
    pairs = staged(pairs.distinct(), "pairs-across")
    # The likeliest pair of each text and component first; what that joins needs no more.
    first = pairs.groupBy("a", "component_b").agg(F.min_by("b", F.struct("cost", "b")).alias("b")).select("a", "b")
    sure = staged(aligned(first, texts).select("a", "b"), "links-across")
    of = pairs.select("a", "b", "component_a", "component_b")
    joined = components(sure.join(of, ["a", "b"]).select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
    for side in "ab":
        now = joined.select(F.col("node").alias(f"component_{side}"), F.col("component").alias(f"now_{side}"))
        of = of.join(now, f"component_{side}", "left").withColumn(f"component_{side}", F.coalesce(f"now_{side}", f"component_{side}"))
    left = of.where("component_a != component_b").select("a", "b").join(first, ["a", "b"], "left_anti")
    return sure.union(staged(aligned(staged(left, "pairs-left"), texts).select("a", "b"), "links-across"))


def distance(a: str, b: str) -> int | None:
    """Edit distance of two texts in words, if it is at most a fifth of the longer one's words, else None.

    The band is widened step by step, so texts that differ little cost little, however long they are.
    """
    x, y = words_of(a), words_of(b)
    longest = max(len(x), len(y))
    if not longest:
        return None
    most = int((1 - SIMILARITY) * longest + 1e-9)
    band = NARROW
    while band < most:
        if (d := distance_within(x, y, band)) is not None:
            return d
        band *= 8
    return distance_within(x, y, most)


def similar(a: str, b: str) -> bool:
    return distance(a, b) is not None


def digest_of(text: Column) -> Column:
    """The digest that sketched() gives a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * DIGEST))


def sketched(docs: DataFrame) -> DataFrame:
    """id, digest (of the whole text), n_words and keys of every row of docs (id, text); only narrow columns."""
    sketcher = docs.sparkSession.sparkContext.broadcast(Sketcher())
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for ids, texts in blocks(batches):
            found = [sketcher.value.sketch(t) for t in texts]
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()[:DIGEST] for t in texts]
            sizes = [t.count(" ") for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(run, "id long, n_words long, digest binary, keys array<long>")


def aligned(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b and their distance d, for the pairs (a, b) whose texts (id, text) are similar."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("d", pa.int64())])

    def run(batches):
        for batch in batches:
            hits = []
            for a, b, x, y in zip(*batch.columns, strict=True):
                if (d := distance(x.as_py(), y.as_py())) is not None:
                    hits.append((a.as_py(), b.as_py(), d))
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hits], pa.int64()) for k in range(3)], schema=schema)

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long, d long")


def with_digests(docs: DataFrame) -> DataFrame:
    """id, text and digest of docs (doc_id, text), null ids as NO_ID and null texts as empty."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("digest", digest_of(F.col("text")))


def spokes(members: DataFrame) -> DataFrame:
    """key, id and head of each text of a bucket but the head: the text that meets most others in all of its buckets, so the one in the middle.

    members: key, id and the number n of texts of the bucket.
    """
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    weighed = members.select("key", "id").join(weights, "id")
    heads = weighed.groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("head"))
    return staged(members.join(heads, "key").where("id != head").select("key", "id", "head"), "spokes")


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches (id, digest, ...) of every row of docs, and for each distinct text its digest, the least id with it
    (first) and the least (id, digest) of its class (least).

    A distinct text is a node with a number of its own, whatever its ids, so texts under one id or without one stay apart.
    """
    rows = with_digests(docs)
    marks = staged(sketched(rows.select("id", "text")), "sketches")
    # Staged, so the numbers stay the same afterwards.
    firsts = staged(marks.groupBy("digest").agg(F.min("id").alias("first")).withColumn("node", F.monotonically_increasing_id()), "texts")
    # One row for each distinct text; several rows of one id and text are one.
    single = marks.join(firsts.select(F.col("first").alias("id"), "digest", "node"), ["id", "digest"]).select("node", F.explode(F.array_distinct("keys")).alias("key")).distinct()
    single = single.withColumnRenamed("node", "id")
    repeated = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(single.join(repeated, "key"), "buckets")
    around = spokes(members)
    stars = around.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    needed = firsts.join(members.select(F.col("id").alias("node")).distinct(), "node").select(F.col("first").alias("id"), "digest", "node")
    found = rows.join(needed, ["id", "digest"]).groupBy("id", "digest").agg(F.min("node").alias("node"), F.min("text").alias("text"))
    texts = staged(found.select(F.col("node").alias("id"), "text"), "candidates")
    links = staged(aligned(stars, texts).select("a", "b"), "links")
    of = components(links)
    placed = around.select("key", "id").join(of.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    whole = components(links.union(across(placed, texts)))
    own = F.struct("first", "digest")
    tied = staged(firsts.join(whole, "node").select("node", "component", own.alias("own")), "linked-texts")
    named = tied.join(tied.groupBy("component").agg(F.min("own").alias("least")), "component").select("node", "least")
    return marks, firsts.join(named, "node", "left").select("digest", "first", F.coalesce("least", own).alias("least"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and copy_of (the least doc_id with the same text) of every row of docs (doc_id, text)."""
    marks, named = grouped(docs)
    back = lambda c, name: F.when(F.col(c) != NO_ID, F.col(c)).alias(name)
    return marks.select("id", "digest").join(named, "digest").select(back("id", "doc_id"), back("least.first", "class_id"), back("first", "copy_of"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the least doc_id of each class, with all columns; of its rows repeated with that doc_id, those of one text, one stays.

    Texts of a class that share its least doc_id are told apart by their digests, so each class keeps one row.
    """
    marks, named = grouped(docs)
    kept = staged(named.where((F.col("least.first") == F.col("first")) & (F.col("least.digest") == F.col("digest"))).select(F.col("first").alias("_kept_id"), F.col("digest").alias("_kept_digest")), "kept")
    own = [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)), digest_of(F.coalesce(docs["text"], F.lit("")))]
    found = docs.join(kept, (own[0] == kept["_kept_id"]) & (own[1] == kept["_kept_digest"]), "left_semi")
    again = marks.join(kept, (marks["id"] == kept["_kept_id"]) & (marks["digest"] == kept["_kept_digest"]), "left_semi").groupBy("id", "digest").count().where("count > 1")
    if again.isEmpty():
        return found
    rows = found.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), digest_of(F.coalesce("text", F.lit(""))).alias("digest"))
    return rows.dropDuplicates(["id", "digest"]).select("row.*")


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """The class of every document, near copies and exact copies together.

    Null texts count as empty; all empty texts are copies of one another. Texts of fewer than two words have one k-mer.
    Very long texts are sketched whole, some of their hashes at a time, and aligned in a band that grows with the edits
    found, so the time is in proportion to length times edits. Rows repeated with one doc_id and text each give the same
    row. Different texts under one doc_id, or without one, are linked each by itself; the class and copy of a row are
    its text's, null where that text has no doc_id. Of heads that tie the least is taken. An empty table gives none.
    Other columns are never read.
    """
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
