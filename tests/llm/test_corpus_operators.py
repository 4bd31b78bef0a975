"""The queries over small tables with odd cases, against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seqloom.llm import decontaminate, mixing, order_minhash, secrets, token_ids, toxicity
from seqloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def bucket(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_empty_pipeline(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_language_id(spark, small, docs):
    got = QUERIES["op1_language_id"](spark, small).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d[0]) for d in docs)
    texts = {d[0]: d for d in docs}
    for r in got:
        text = texts[r["doc_id"]][1]
        assert r["held_out"] == (bucket(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        if r["doc_id"] is not None and r["doc_id"] < 60:
            assert r["lang_pred"] == texts[r["doc_id"]][2]


def test_decontamination(spark, small):
    got = QUERIES["op2_decontamination"](spark, small).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(91, 1)]
    assert got[0]["question_overlap"] == got[0]["answer_overlap"] == 1.0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = decontaminate.keep_clean(docs, spark.read.parquet(f"{small}/benchmark.parquet"))
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1


def test_decontamination_by_shards_finds_the_same(spark, small, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 5)
    assert [(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontamination"](spark, small).collect()] == [(91, 1)]


def test_shards_dont_change_a_score(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(90)]
    items = [(k, " ".join(rng.choice(words, int(rng.choice([9, 25, 70]))))) for k in range(60)]
    docs = []
    for k, text in items:  # every other word of a passage is changed from some place on, so scores are partial
        own = text.split()
        cut = len(own) * (6 + k % 4) // 10
        docs.append((k, " ".join([*rng.choice(words, 20), *own[:cut], *(w if j % 2 else "other" for j, w in enumerate(own[cut:])), *rng.choice(words, 20)])))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, items[0]], "item_id long, text string")
    one = sorted(map(tuple, decontaminate.leaks(*frames).collect()))
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 1500)
    monkeypatch.setattr(F, "xxhash64", lambda *c, hashed=F.xxhash64: hashed(*c).bitwiseAND(F.lit(3)))  # few shards, to be quick
    assert sum(1 for _ in decontaminate.indexes(frames[1])) > 3
    assert len(one) > 10 and min(x[2] for x in one) < 1 and sorted(map(tuple, decontaminate.leaks(*frames).collect())) == one


def test_mixing(spark, small, docs):
    got = QUERIES["op3_mixing"](spark, small).collect()
    assert len(got) == len(docs)
    total = sum(r["n_tokens"] for r in got)
    assert sum(r["n_tokens"] * r["prob"] for r in got) == pytest.approx(mixing.BUDGET * total, rel=0.02)
    assert all(r["sampled"] for r in got if r["n_tokens"] == 0) and all(0 <= r["prob"] <= 1 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] == 83} == {2}
    frame = spark.read.parquet(f"{small}/documents.parquet")
    kept = mixing.keep_sampled(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["sampled"])
    assert sorted((str(r["doc_id"]), r["prob"]) for r in QUERIES["op3_mixing"](spark, small).collect()) == sorted((str(r["doc_id"]), r["prob"]) for r in got)


def test_mixing_in_spark_agrees_with_the_driver(spark):
    cells = spark.createDataFrame([(f"s{k % 3}", f"l{k % 4}", f"t{k % 5}", 10 + k * 7 % 90) for k in range(60)], "source string, lang string, topic string, tokens long").groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    one, two = mixing.calibrate(cells), mixing.calibrate(cells, driver_cells=0)
    pairs = {tuple(r[:3]): r["prob"] for r in one.collect()}
    for r in two.collect():
        assert r["prob"] == pytest.approx(pairs[r["source"], r["lang"], r["topic"]], rel=1e-3)


@pytest.mark.parametrize("targets", [None, {"source": {"s0": 0.7}, "lang": {"l1": 0.2, "l2": 0.5, "unseen": 0.3}}])
def test_mixing_in_spark_has_the_rules_of_the_driver(spark, targets):
    """Cells without tokens stay, and values without a target have their natural share, however many cells there are."""
    rows = [(f"s{k % 2}", f"l{k % 3}", "t", 10 + k * 7 % 90) for k in range(6)] + [("s0", "l0", "empty", 0), ("none", "l1", "empty", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    one, two = ({tuple(r[:3]): r["prob"] for r in mixing.calibrate(cells, targets, driver_cells=n).select(*mixing.DIMENSIONS, "prob").collect()} for n in (100, 0))
    assert one["s0", "l0", "empty"] == one["none", "l1", "empty"] == 1.0
    assert two == pytest.approx(one, rel=1e-6)


def sketch(text):
    words = (text or "").split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_fingerprints(spark, small, docs):
    got = QUERIES["op4_fingerprints"](spark, small).collect()
    assert len(got) == len(docs)
    ids = sorted({d[0] for d in docs if d[0] is not None}, reverse=True) + [None]
    text = {d[0]: d[1] or "" for d in docs}
    by_text = {}
    for r in got:
        own, nxt = text[r["doc_id"]], text[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        k = len(own) // 3
        edited = own[: len(own) - k] + nxt[:k]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(own, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        a, b = sketch(own), sketch(edited)
        if own == edited:
            assert r["near_edited"] == 1
        elif len(a) > 100:
            assert abs(r["near_edited"] - len(a & b) / min(len(a), len(b))) < 0.35


def test_fingerprint_of_one_document(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (row,) = QUERIES["op4_fingerprints"](spark, str(tmp_path)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"a b c d e a b c"[:10] + b"a b c").hexdigest() and row["near_next"] in (0.0, 1.0)


def test_secrets(spark, small, docs):
    got = {r["doc_id"]: r for r in QUERIES["op5_secrets"](spark, small).collect()}
    for key, text, *_ in docs:
        base, every, _, _ = secrets.find(text or "")
        assert got[key]["base_sha256"] == hashlib.sha256(secrets.written(base).encode()).hexdigest() and got[key]["spans"] == secrets.written(every)


def test_warc(spark, small):
    got = sorted((r for r in QUERIES["op6_warc"](spark, small).collect()), key=lambda r: r["page_id"])
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    by = defaultdict(list)
    for key, body in pages:
        by[body].append(key)
    want = []
    for key, body in sorted(pages):
        again = len(body) >= 1000 and max(by[body]) != key
        want.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", max(by[body]) if again else None))
    assert [tuple(r)[:5] for r in got] == want and all(r["intact"] for r in got)


def brute_classes(docs):
    """Components of all pairs of distinct texts that are similar, and of equal ones."""
    first = {}
    for key, text, *_ in sorted(docs, key=lambda d: -(1 << 63) if d[0] is None else d[0]):
        first.setdefault(text or "", -(1 << 63) if key is None else key)
    texts = sorted(first, key=first.get)
    home = {t: first[t] for t in texts}
    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if order_minhash.similar(a, b) and home[a] != home[b]:
                lo, hi = sorted((home[a], home[b]))
                home = {t: lo if h == hi else h for t, h in home.items()}
    return {key: home[text or ""] for key, text, *_ in docs}


def test_near_duplicates(spark, small, docs):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op7_near_duplicates"](spark, small).collect()}
    want = brute_classes(docs)
    back = lambda c: None if c == -(1 << 63) else c
    assert {k: back(v) for k, v in want.items()} == got
    assert {got[k] for k in range(60, 75)} == {60} and got[80] == got[81] == 80
    frame = spark.read.parquet(f"{small}/documents.parquet")
    kept = order_minhash.keep_one(frame)
    assert kept.columns == frame.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(k) for k in set(got) if got[k] == k)


def test_texts_that_share_an_id_or_have_none_stay_apart(spark):
    base = [[f"{name}{k}" for k in range(60)] for name in "abcdef"]
    text = [" ".join(x) for x in base]
    near = [" ".join([*x[:30], "changed", *x[31:]]) for x in base]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, near[1]), (3, text[2]), (3, text[3]), (4, near[2]), (5, near[3]), (6, text[4]), (6, text[4]), (7, text[5])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(frame).collect()}
    assert got == {None: None, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7}
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in order_minhash.keep_one(frame).collect())
    one = min(text[1], near[1], key=lambda t: hashlib.sha256(t.encode()).digest())
    assert kept == sorted([(0, text[0]), (0, one), (3, text[2]), (3, text[3]), (6, text[4]), (7, text[5])])


def test_links_that_miss_the_bucket_head_are_found(spark):
    passage = " ".join(f"p{k}" for k in range(120))
    rows = [(k, passage + " " + " ".join(f"o{k}x{i}" for i in range(60))) for k in range(12)]
    rows += [(20, passage + " " + " ".join(f"s{i}" for i in range(60))), (21, passage + " " + " ".join(f"s{i}" for i in range(57)) + " t1 t2 t3")]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{k: k for k in range(12)}, 20: 20, 21: 20}


@pytest.mark.parametrize(("name", "fold", "rest"), [("op8_quality_classifier", 5, 0), ("op10_toxicity", 4, 2)])
def test_classifiers(spark, small, docs, name, fold, rest):
    got = QUERIES[name](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (bucket(r["doc_id"], fold) == rest) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    if name == "op10_toxicity":
        assert {r["doc_id"] for r in got if r["predicted"]} == set(range(92, 98))


def reference_tokens(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_ids.default_vocabulary())
    return {k: tok.encode(t or "", add_special_tokens=False).ids + [token_ids.END_ID] for k, t in docs}


def test_token_ids(spark, small, docs):
    got = sorted(QUERIES["op9_token_ids"](spark, small).collect(), key=lambda r: r["start"])
    want = reference_tokens([d[:2] for d in docs])
    ids = sorted((d[0] for d in docs), key=lambda k: -1 if k is None else k)
    assert [r["doc_id"] for r in got] == ids
    start = 0
    for r in got:
        own = want[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def test_a_shard_can_be_read_in_any_order(spark, small, docs):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    manifest = token_ids.write_shards(frame, shards=3)
    want = reference_tokens([d[:2] for d in docs])
    shard = token_ids.Shard(manifest[-1]["path"])
    for k in reversed(range(len(shard))):
        assert shard.ids(k).tolist() == want[shard.doc_ids.select(k)]
    assert sum(x["n_docs"] for x in manifest) == len(docs)


def test_pipeline_against_its_parts(spark, small, docs):
    toxic = {r["doc_id"] for r in QUERIES["op10_toxicity"](spark, small).where("predicted = 1").collect()}
    left = [d for d in docs if d[0] not in toxic]
    homes = brute_classes(left)
    seen, single = set(), []
    for d in left:
        if homes[d[0]] == (-(1 << 63) if d[0] is None else d[0]) and d[0] not in seen:
            seen.add(d[0])
            single.append(d)
    index = decontaminate.BlockMaxIndex([(1, "What is the colour of the tall ship? It is a pale sea green 77"), (2, "Never seen words stand in here and nowhere else at all")])
    clean = [d for d in single if not index.leaks(d[1] or "")]
    frame = spark.createDataFrame(clean, "doc_id long, text string, lang string, source string")
    sampled = [r["doc_id"] for r in mixing.mix(frame).where("sampled").collect()]
    got = corpus_pipeline.run(spark, small).orderBy("start").collect()
    ids = sorted(sampled, key=lambda k: -1 if k is None else k)
    assert [r["doc_id"] for r in got] == ids
    want = reference_tokens([d[:2] for d in clean])
    assert [r["n_tokens"] for r in got] == [len(want[k]) for k in ids]


def test_stages_keep_the_columns(spark, small):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, small)
        assert out.columns == frame.columns and [f.dataType for f in out.schema] == [f.dataType for f in frame.schema]


def test_the_sample_is_the_same_however_rows_are_dealt(spark, small):
    frame, labels = spark.read.parquet(f"{small}/documents.parquet"), toxicity.labelled(spark, small)
    one = toxicity.fit(frame, labels)
    two = toxicity.fit(frame.repartition(5), labels.repartition(4))
    assert one.weights == two.weights and one.bias == two.bias
