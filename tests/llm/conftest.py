import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns whose names the operators use themselves
        *(T.StructField(n, T.StringType()) for n in ("id", "key", "tie", "score", "prob", "component", "digest", "topic", "weight", "copies", "n_tokens", "row", "own", "_own_source", "_cell_lang", "_kept_digest")),
    ]
)
EN = "the of and to in that it was for on with as his they be at one have this from".split()
FR = "le la de et les des en un une que est pour qui dans sur pas au avec son il".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "s", "ing", "er"]) + str(rng.randrange(400) if rng.random() < 0.15 else "") for _ in range(n))


def rows():
    rng = random.Random(12)
    out = []
    for k in range(60):
        lang, words = (("en", EN), ("fr", FR))[k % 2]
        out.append((k, prose(rng, words, rng.choice([8, 40, 120])) + ".", lang, "hot" if k % 3 else f"s{k % 4}"))
    base = [f"w{rng.randrange(10**5)}" for _ in range(150)]
    for k in range(60, 70):  # near copies
        near = list(base)
        near[k] = "changed"
        out.append((k, " ".join(near), "en", "hot"))
    out += [(k, " ".join(base), "en", "hot") for k in range(70, 75)]  # exact copies
    out += [(80, None, "en", None), (81, "", None, "s1"), (82, "   \n", "fr", "s1"), (83, "one two", "en", "s2"), (84, "123 456 !", None, None)]
    out += [(85, " ".join(base[:100] * 120), "en", "s2"), (86, "x" * 30_000, "en", "s2")]  # very long; one long word
    out += [(90, out[0][1], "en", "s1")] * 2  # a row repeated
    out += [(91, "what is the colour of the tall ship? It is a pale sea green 77 " + out[3][1], "en", "s1")]
    out += [(92 + k, f"you are an idiot and a scum {k} really", "en", "s1") for k in range(6)]
    out += [(None, "a row without an id", "en", "s1")]
    return [(*r, None if r[1] is None else len(r[1]), *["clash"] * 16) for r in out]


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """A folder with small tables that hold the odd cases."""
    folder = tmp_path_factory.mktemp("small")
    data = rows()
    spark.createDataFrame(data, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(r[0] % 7 != 0), int("idiot" in (r[1] or ""))) for r in data if r[0] is not None and r[1]] + [(5, None, None), (None, 1, 1), (9999, 1, 0), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "What is the colour of the tall ship? It is a pale sea green 77"), (1, "What is the colour of the tall ship? It is a pale sea green 77"), (2, "Never seen words stand in here and nowhere else at all"), (3, None), (4, ""), (None, "x")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    big = "<p>" + "page é " * 300 + "</p>"
    pages = [(k, f"http://h/{k}", big) for k in (1, 5, 3)] + [(2, None, None), (4, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "y" * 1000), (9, "v", "y" * 1000), (9, "v", "y" * 1000), (10, "w", "z" * 600_000), (11, "a\nb", "é" * 499)]
    spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").write.parquet(f"{folder}/pages.parquet")
    rng = random.Random(4)
    vectors = [(k, [rng.gauss(0, 1) for _ in range(16)], k % 3) for k in range(20)]
    vectors += [(20, vectors[0][1], None), (21, [2 * x for x in vectors[1][1]], 1), (22, None, 1), (23, [0.0] * 16, 2), (24, [float("nan")] * 16, 2), (None, vectors[2][1], 0), vectors[3]]
    spark.createDataFrame([(*v, "x", "x") for v in vectors], "vec_id long, embedding array<float>, label int, code string, node string").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory, small):
    folder = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
