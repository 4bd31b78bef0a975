"""Queries that SQL can't express against plain versions of the same job, written apart from the operators."""

import base64
import binascii
import gzip
import hashlib
import math
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest

from seqloom.llm import language_id, mixing, quality, secrets, token_ids, toxicity
from seqloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def bucket(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def labels_of(spark, small, column, n, held):
    """The largest label of each document that may be learnt from."""
    best = {}
    for r in spark.read.parquet(f"{small}/labels.parquet").collect():
        if r["doc_id"] is not None and r[column] is not None and bucket(r["doc_id"], n) != held:
            best[r["doc_id"]] = max(best.get(r["doc_id"], 0), r[column])
    return best


def samples(docs, labels):
    """Texts and labels by label and id, each row of documents once; the fixture has fewer than the sample's bound."""
    return sorted((labels[d[0]], d[0], d[1]) for d in docs if d[0] in labels and d[1] is not None)


def plain_sum(model, word):
    """Probability of a word for each language: all segmentations, as a sum over prefixes."""
    marked = "▁" + word
    sums = [np.ones(len(model.langs))]
    for j in range(1, len(marked) + 1):
        total = np.zeros(len(model.langs))
        for i in range(j):
            piece = marked[i:j]
            row = model.index.get(piece, 1 if j - i == 1 else None)
            if row is not None:
                total += sums[i] * model.table[row] / language_id.SCALE ** (j - i)
        sums.append(total)
    return np.log(sums[-1])


def test_languages(spark, small, docs):
    got = {(r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in QUERIES["op1_language_id"](spark, small).collect()}
    learnt = sorted({(d[2], d[0], d[1]) for d in docs if None not in d[:3] and bucket(d[0], 4) != 2})  # a row repeated counts once
    texts = {lang: [x[2] for x in learnt if x[0] == lang] for lang in {x[0] for x in learnt}}
    model = language_id.train(texts, language_id.read_pieces(language_id.default_vocabulary()))
    want = set()
    for key, text, *_ in docs:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not any(c.isalpha() for w in words for c in w):
            want.add((key, "und", 0.0))
        elif max(map(len, words)) < 30:
            total = sum(n * plain_sum(model, w) for w, n in Counter(words).items())
            share = np.exp(total - total.max())
            want.add((key, model.langs[int(total.argmax())], round(float(share.max() / share.sum()), 9)))
    assert want <= got and len(got) - len(want) <= 1  # the fixture's one endless word


def test_quality_scores(spark, small, docs):
    found = samples(docs, labels_of(spark, small, "quality", 5, 0))
    model = quality.fit_texts([x[2] for x in found], [x[0] for x in found])
    got = sorted((str(r["doc_id"]), round(r["score"], 9)) for r in QUERIES["op8_quality_classifier"](spark, small).collect())
    want = []
    for key, text, *_ in docs:
        margin = model.bias + sum(w for f, w in model.weights.items() if f in quality.Featuriser().features(text or ""))
        want.append((str(key), round(1 / (1 + math.exp(-(model.scale[0] * margin + model.scale[1]))), 9)))
    assert got == sorted(want)


def test_toxicity_scores(spark, small, docs):
    found = samples(docs, labels_of(spark, small, "toxic", 4, 2))
    model = toxicity.fit_texts([x[2] for x in found], [x[0] for x in found])
    got = sorted((str(r["doc_id"]), round(r["score"], 9)) for r in QUERIES["op10_toxicity"](spark, small).collect())
    want = []
    for key, text, *_ in docs:
        margin = model.bias + sum(w for f, w in model.weights.items() if f in toxicity.features(text or ""))
        want.append((str(key), round(1 / (1 + math.exp(-margin)), 9)))
    assert got == sorted(want)


def test_swaps_that_occur_move_the_score_less_with_the_penalty():
    rng = np.random.default_rng(3)
    usual = [f"ta{c}le{d}" for c in "bcdfg" for d in "aeiou"]  # neutral words that share prefixes with a marked one
    texts, y = [], []
    for k in range(400):
        toxic = k % 4 == 0
        texts.append(" ".join([*rng.choice(usual, 6), *(["tablescum"] if toxic else ["garden"])]))
        y.append(int(toxic))
    sets = toxicity.neutral_sets(texts, np.array(y, float), most=0.9)
    assert len(sets) >= 2 and not {"tablescum", "garden"} & {w for s in sets for w in s}
    free, tied = toxicity.fit_texts(texts, y, groups=()), toxicity.fit_texts(texts, y)
    (n, before), (m, after) = (toxicity.swap_change(model, texts, sets) for model in (free, tied))
    assert n == m > 300 and after <= before and tied.score("you tablescum") > 0.3 > tied.score("a garden")


def test_the_sample_is_that_of_the_least_hashes(spark):
    from pyspark.sql import functions as F

    from seqloom.llm.common import bounded_sample

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("y"), F.concat(F.lit("t"), "id").alias("text"))
    rows = rows.union(rows.limit(50)).union(spark.sql("SELECT null, 1, 'x' UNION ALL SELECT 7, null, 'x'"))
    hashed = sorted((r["h"], r["doc_id"], r["y"]) for r in rows.where("doc_id is not null and y is not null").select(F.xxhash64("doc_id").alias("h"), "doc_id", "y").distinct().collect())
    want = {(y, k) for y in (0, 1) for _, k, _ in [x for x in hashed if x[2] == y][:40]}
    assert {x[:2] for x in bounded_sample(rows, rows.where("doc_id is not null").dropDuplicates(["doc_id"]), "doc_id", "y", 40)} == want
    assert bounded_sample(rows.limit(0), rows, "doc_id", "y", 40) == []


def plain_mix(docs):
    """Raking in plain loops: tokens by cell, each dimension scaled to its target in turn, one factor for the budget."""
    cells = {}
    for d in docs:
        t = d[1] or ""
        if not t.strip(" "):
            topic = "empty"
        elif "License" in t or "Copyright" in t:
            topic = "legal"
        elif " | " in t:
            topic = "table"
        elif "!! " in t:
            topic = "loud"
        elif "@" in t or "http" in t:
            topic = "contact"
        else:
            topic = "short prose" if len(t) < 1000 else "prose"
        cells.setdefault((d[3] or "", d[2] or "", topic), []).append(len(t.split()))
    tokens = {c: sum(n) for c, n in cells.items()}
    whole = sum(tokens.values())
    share = {c: n / whole for c, n in tokens.items()}
    targets = []
    for k, name in enumerate(mixing.DIMENSIONS):
        own = Counter()
        for c, n in tokens.items():
            own[c[k]] += n
        raised = {v: n ** mixing.TEMPER[name] if n else 0.0 for v, n in own.items()}
        targets.append({v: x / sum(raised.values()) for v, x in raised.items()})
    for _ in range(300):
        for k, target in enumerate(targets):
            now = Counter()
            for c, x in share.items():
                now[c[k]] += x
            share = {c: x * target[c[k]] / now[c[k]] if now[c[k]] else x for c, x in share.items()}
    weight = {c: share[c] / n if n else 0.0 for c, n in tokens.items()}
    low, high = 0.0, 1 / min(w for w in weight.values() if w)
    for _ in range(200):
        mid = (low + high) / 2
        enough = sum(min(1, mid * weight[c]) * n for c, n in tokens.items()) >= mixing.BUDGET * whole
        low, high = (low, mid) if enough else (mid, high)
    return {c: min(1.0, high * weight[c]) if n else 1.0 for c, n in tokens.items()}


def test_mixing_probabilities(spark, small, docs):
    want = plain_mix(docs)
    for r in QUERIES["op3_mixing"](spark, small).collect():
        assert r["prob"] == pytest.approx(want[r["source"], r["lang"], r["topic"]], abs=1e-6)


def test_sampled_tokens_have_the_target_shares(spark):
    rows = spark.range(40_000).selectExpr(
        "id AS doc_id", "concat('s', pmod(xxhash64(id, 1), 10) div 4) AS source", "concat('l', pmod(xxhash64(id, 2), 7) div 3) AS lang", "repeat('word ', cast(5 + pmod(xxhash64(id, 3), 30) as int)) AS text"
    )
    targets = {"source": {"s0": 0.2, "s1": 0.3, "s2": 0.5}, "lang": {"l0": 0.3, "l1": 0.3, "l2": 0.4}, "topic": {"short prose": 1.0}}
    got = mixing.mix(rows, targets, budget=0.1).where("sampled").select("source", "lang", "n_tokens", "prob").collect()
    assert max(r["prob"] for r in got) < 1  # none is clipped, so the shares are those wanted but for chance
    total = sum(r["n_tokens"] for r in got)
    for k, name in enumerate(("source", "lang")):
        for value, wanted in targets[name].items():
            assert sum(r["n_tokens"] for r in got if r[k] == value) / total == pytest.approx(wanted, abs=0.03)


BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def plain_base(text):
    found = [(m.start(), order, m.end(), kind) for order, (kind, pattern, holds) in enumerate(BASE) for m in pattern.finditer(text) if holds(m)]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def plain_layers(text, depth=0):
    """Texts below one, by whole tokens: what a URL-escaped, base64 or compressed token stands for, and so on."""
    yield text
    for token in text.split() if depth < 6 else ():
        if "%" in token and (plain := urllib.parse.unquote(token)) != token:
            yield from plain_layers(plain, depth + 1)
        try:
            data = base64.b64decode(token, validate=True)
        except (binascii.Error, ValueError):
            continue
        for unpack in (lambda x: x, gzip.decompress, zlib.decompress):
            try:
                yield from plain_layers(unpack(data).decode(), depth + 1)
            except (OSError, zlib.error, EOFError, UnicodeDecodeError):
                pass


def test_secrets(spark, tmp_path):
    rng = np.random.default_rng(5)
    plain = ["password = hunter22", "API_KEY: 'abcdef123'", "token=x", "AKIA" + "Q7" * 9, "0af3" * 7, "toKen=ok=longer.1", "secret:é", "nothing", "deadbeef" * 2]
    wraps = [lambda s: base64.b64encode(s.encode()).decode(), lambda s: urllib.parse.quote(s, safe=""), lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(), lambda s: base64.b64encode(zlib.compress(s.encode())).decode()]
    rows = [(0, None), (1, "")]
    for k in range(2, 60):
        parts = []
        for _ in range(rng.integers(1, 5)):
            part = f"see {plain[rng.integers(len(plain))]} so"
            for _ in range(rng.integers(0, 4)):
                part = wraps[rng.integers(4)](part)
            parts.append(part)
        rows.append((k, " and ".join(parts)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op5_secrets"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    deep = 0
    for key, text in rows:
        base, row = plain_base(text or ""), got[key]
        written = ",".join(f"{kind}:{a}:{b}" for kind, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind, *_ in BASE] == [sum(x[0] == kind for x in base) for kind, *_ in BASE]
        spans = {tuple(x.rsplit(":", 2)) for x in row["spans"].split(",") if x}
        assert {(kind, str(a), str(b)) for kind, a, b in base} <= spans
        kinds = {kind for layer in plain_layers(text or "") for kind, *_ in plain_base(layer)}
        assert kinds <= {x[0] for x in spans}
        deep += len(spans) > len(base)
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in spans)
    assert deep > 20


def test_ids_of_letters_that_normal_form_takes_apart():
    from unicodedata import normalize

    from tokenizers import Tokenizer

    path = token_ids.default_vocabulary()
    plain, own = Tokenizer.from_file(path), token_ids.CachedTokenizer(open(path, encoding="utf-8").read())
    letters = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and c.isalpha() and (ord(c) < 0x600 or normalize("NFC", c) != c or len(normalize("NFD", c)) > 1 and ord(c) < 0x3000)]
    words = [head + c + tail for k, c in enumerate(letters) for head in ("", "ab") for tail in (token_ids.TAIL[k % len(token_ids.TAIL)], ".,")]
    want = [x.ids for x in plain.encode_batch(words, add_special_tokens=False)]
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(words)] == want and len(words) > 5000


def test_equal_sketches_are_alike_and_an_empty_one_is_like_no_other(spark, tmp_path):
    rows = [(k, text) for k, text in enumerate(["", None, "a b", "", "one two three four five six seven " * 9])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op4_fingerprints"](spark, str(tmp_path)).collect()}
    for key, r in got.items():
        nxt = got[key - 1 if key else 4]
        for own, other, near in ((r["fingerprint"], r["edited_fingerprint"], r["near_edited"]), (r["fingerprint"], nxt["fingerprint"], r["near_next"])):
            if own == other:
                assert near == 1
            elif not own or not other:
                assert near == 0
    assert got[1]["near_next"] == 1  # two texts without words


def test_a_sample_takes_one_text_of_a_key_and_its_value(spark, monkeypatch):
    from seqloom.llm import common

    rows = [(1, "en", "an english text"), (1, "fr", "un texte"), (1, None, "no language"), (2, "en", "b"), (2, "en", "a"), (None, "en", "x"), (3, "fr", None), (4, "fr", "y" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    many = docs.union(spark.range(100_000).selectExpr("5L", "'en'", "concat('again ', cast(id % 7 as string))"))
    got = common.bounded_sample(many.where("text is not null"), many, "doc_id", "lang", 10, of_value=True)
    assert [x[:2] for x in got] == [("en", 1), ("en", 2), ("en", 5), ("fr", 1), ("fr", 4)]
    assert dict((x[:2], x[2]) for x in got)["en", 1] == "an english text" and dict((x[:2], x[2]) for x in got)["fr", 1] == "un texte"
    assert got == common.bounded_sample(many.repartition(9).where("text is not null"), many.repartition(5), "doc_id", "lang", 10, of_value=True)
    monkeypatch.setattr(common, "TEXT_CHARS", 40)
    assert [x[:2] for x in common.bounded_sample(docs, docs, "doc_id", "lang", 10, of_value=True)] == [("en", 1), ("en", 2), ("fr", 1)]
    monkeypatch.setattr(common, "SAMPLE_CHARS", 15)
    assert sum(len(x[2]) for x in common.bounded_sample(docs, docs, "doc_id", "lang", 10, of_value=True) if x[0] == "en") <= 15


def test_long_words_are_learnt_from():
    """The sums from both ends of a long word give the expectations that the table of a short one gives."""
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "bab"]
    model = language_id.PieceModel(pieces, ["x"])
    probs = np.array([[0.1], [0.1], [0.2], [0.2], [0.2], [0.1], [0.1]])
    table = model._scaled(probs)
    for word in ("▁ab", "▁ababcab", "▁bb"):
        expected = np.zeros(len(pieces) + 1)
        model.expect_long(word, table[:, 0], 2.0, expected)
        want, total = np.zeros(len(pieces) + 1), 0.0

        def go(at, used, p):
            nonlocal total
            if at == len(word):
                total += p
                want[:] += p * np.bincount(used, minlength=len(want))
                return
            for size in range(1, model.most + 1):
                row = model.index.get(word[at : at + size], 1 if size == 1 else None) if at + size <= len(word) else None
                if row is not None:
                    go(at + size, [*used, row], p * table[row, 0])

        go(0, [], 1.0)
        assert np.allclose(expected, 2 * want / total)
    learnt = language_id.train({"x": ["a" * 60 + " " + "a" * 60], "y": ["b" * 60]}, pieces)
    assert learnt.predict(["a" * 55])[0][0] == "x" and learnt.predict(["b" * 70])[0][0] == "y"
