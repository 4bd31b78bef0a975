"""The parts of the corpus operators that need no Spark, against brute force."""

import base64
import gzip
import hashlib
import io
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from seqloom.llm import decontaminate, linear, mixing, quality, secrets, token_ids, toxicity, warc
from seqloom.llm.alignment import distance_within
from seqloom.llm.elias_fano import EliasFano
from seqloom.llm.language_id import default_vocabulary as piece_vocabulary, read_pieces, train, words_of
from seqloom.llm.order_minhash import FAMILIES, SIMILARITY, Sketcher, WordHashes, labelled_words, similar


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25), st.integers(0, 12))
def test_banded_distance_is_the_edit_distance(a, b, most):
    d = edit_distance(a, b)
    assert distance_within(a, b, most) == (d if d <= most else None)


def test_banded_distance_of_long_texts_with_common_words():
    rng = random.Random(3)
    a = [rng.choice("ab") if rng.random() < 0.5 else rng.randrange(10**6) for _ in range(900)]
    b = list(a)
    for _ in range(60):
        b[rng.randrange(len(b))] = rng.randrange(10**6)
    del b[100:130]
    assert distance_within(a, b, 180) == edit_distance(a, b)
    assert distance_within(a, b, 50) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-(2**40), 2**62), max_size=700))
def test_elias_fano_gives_back_its_values(values):
    values = sorted(values)
    code = EliasFano.load(EliasFano.encode(np.array(values, np.int64)).dump())
    assert code.values().tolist() == values
    for k in range(0, len(values), 7):
        assert code.select(k) == values[k]
    assert code.values(100, 300).tolist() == values[100:300]


def test_elias_fano_is_small_and_refuses_falling_values():
    values = np.cumsum(np.random.default_rng(0).integers(1, 1000, 50_000))
    assert EliasFano.encode(values).bits() / len(values) < 2 + np.log2(values[-1] / len(values)) + 1
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1]))


TEXTS = ["", " ", "a", "İstanbul, ĲSSEL ﬁne", "the cat's don't; we'll", "x<|endoftext|>y <|startoftext|>", "á été, 12ab3 \x01 b\x01c   d\x1ce", "東京 は　夜 😀😀!!", "Å ½ Ⅷ ² _x_ __", "tab\tnew\r\nline  two", "ǅ Σίσυφος ΣΑΣ"]


def test_tokens_are_those_of_the_library_for_odd_texts():
    from tokenizers import Tokenizer

    path = token_ids.default_vocabulary()
    plain, own = Tokenizer.from_file(path), token_ids.CachedTokenizer(open(path, encoding="utf-8").read())
    rng = random.Random(1)
    odd = TEXTS + ["".join(rng.choice("aB é ü.,'!%\n\t12_-İß́") for _ in range(rng.randrange(60))) for _ in range(400)]
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(odd)] == [plain.encode(t, add_special_tokens=False).ids for t in odd]
    assert own.split_by_space


def segmentations(word, pieces):
    if not word:
        return [[]]
    out = []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces or k == 1:
            out += [[word[:k], *rest] for rest in segmentations(word[k:], pieces)]
    return out


def test_forward_sum_is_the_sum_over_all_segmentations():
    pieces = ["<unk>", "▁", "▁a", "a", "b", "ab", "▁ab", "ba"]
    model = train({"x": ["ab abab aba"], "y": ["bab ba q"]}, pieces)
    table = {p: model.table[1 + i] / 16.0 ** max(1, len(p) if i else 1) for i, p in enumerate(pieces)}
    for word in ("abab", "baq", "a" * 9):
        sums = np.zeros(2)
        for seg in segmentations("▁" + word, set(pieces[1:])):
            sums += np.prod([table[s] if s in pieces[1:] else table["<unk>"] for s in seg], axis=0)
        got = model.text_scores([word]) - (len(word) + 1) * np.log(16.0)
        assert np.allclose(got, np.log(sums))
    long = "ab" * 40
    model.cache.clear()
    whole = model.text_scores([long])
    ids, spans = model.lattice(["▁" + long], len(long) + 1)
    assert np.allclose(whole, np.log(model.forward(ids, spans, len(long) + 1, model.table)[-1][0]))


def test_language_of_plain_sentences_and_texts_without_letters():
    samples = {"en": ["the cat sat on the mat and the dog ran"] * 3, "fr": ["le chat est sur la table et le chien court"] * 3}
    model = train(samples, read_pieces(piece_vocabulary()))
    assert [x[0] for x in model.predict(["the dog and the cat", "le chien et la table", "123 !", None, ""])] == ["en", "fr", "und", "und", "und"]
    assert words_of("Ab1c_D é") == ["ab", "c", "d", "é"]


def test_block_max_wand_finds_what_all_scores_find():
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(60)]
    index = decontaminate.BlockMaxIndex([(k, " ".join(rng.choices(vocab, k=rng.randrange(1, 30)))) for k in range(70)])
    for _ in range(200):
        terms = sorted({index.term[w] for w in rng.choices(vocab, k=12) if w in index.term})
        scores = {}
        for t in terms:
            for p, x in zip(index.items[t], index.impacts[t], strict=True):
                scores[p] = scores.get(p, 0) + x
        for threshold in (0.05, 0.3, 0.6):
            assert {p for p, _ in index.search(terms, threshold)} == {p for p, x in scores.items() if x >= threshold - 1e-9}


def test_windows_lose_no_verbatim_item():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([4, 15, 40])))) for k in range(40)]
    index = decontaminate.BlockMaxIndex(items)
    for key, text in items:
        before, after = (" ".join(rng.choices(words, k=rng.randrange(120))) for _ in range(2))
        assert key in {x[0] for x in index.leaks(f"{before} {text} {after}")}
    assert index.leaks("") == [] and decontaminate.BlockMaxIndex([]).leaks("a b") == []


@pytest.mark.parametrize("answer", ["Canberra", "north of Cooma", "by the old lake"])
def test_a_short_answer_is_found_apart_from_its_question_and_beside_an_edit(answer):
    question = "Which planned inland city became the seat of the federal parliament in the year 1927?"
    index = decontaminate.BlockMaxIndex([(1, f"{question} {answer}"), (2, "Nothing of all these things is said here, is it? Never at all")])
    for text in (f"{question} The correct choice is: {answer}", f"{question.replace('year', 'summer')} {answer}"):
        assert [x[0] for x in index.leaks(f"some words before {text} and some after")] == [1]
    assert index.leaks(f"some words before {question} and no reply") == []


def test_question_and_answer():
    assert decontaminate.question_and_answer("How many? Four of them") == (["how", "many"], ["four", "of", "them"])
    assert decontaminate.question_and_answer("Add. Answer: four") == (["add", "answer"], ["four"])
    assert decontaminate.question_and_answer("a b c d e f g h") == (list("abcdef"), list("gh"))


def test_secret_spans_in_plain_text():
    text = "é password: 'abc12345' Token=x token=ok=longer AKIA" + "A" * 16 + " " + "0" * 24 + " " + "f" * 23
    base, every, layers, _ = secrets.find(text)
    assert [(text[a:b], k) for a, b, k in base] == [("password: 'abc12345", 0), ("token=ok=longer", 0), ("AKIA" + "A" * 16, 1), ("0" * 24, 2)]
    assert every == base and layers == 1


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: urllib.parse.quote(s, safe=""),
        lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
        lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(),
        lambda s: urllib.parse.quote(base64.b64encode(zlib.compress(base64.b64encode(s.encode()))).decode(), safe=""),
    ],
)
def test_secrets_in_nested_encodings_are_told_as_spans_of_the_text(wrap):
    coded = wrap("my password = hunter22 and so on")
    text = f"Seite äöü {coded} end"
    _, every, _, _ = secrets.find(text)
    finds = [(a, b) for a, b, k in every if k == 0]
    assert len(finds) == 1 and 10 <= finds[0][0] < finds[0][1] <= 10 + len(coded)


def wrapped(data, width=76):
    coded = base64.b64encode(data).decode()
    return "\n".join(coded[k : k + width] for k in range(0, len(coded), width))


SECRET = b"my password = hunter22 and so on"
FILL = bytes(random.Random(4).choices(b"abcdefghijklmnop \n", k=400))


@pytest.mark.parametrize(
    "coded",
    [
        *(base64.b64encode(x.encode() + SECRET).decode() for x in "\u00a0\u200b\u200d\ufeff\u00ad\0\f"),
        base64.b64encode(gzip.compress("prix\u00a0: ".encode() + SECRET, mtime=0)).decode(),
        base64.b64encode("été ".encode("latin-1") + SECRET).decode(),
        wrapped(FILL[:45] + SECRET),
        wrapped(gzip.compress(FILL + SECRET, mtime=0)),
        "SomeNameOnALineOfItsOwn\n" + wrapped(gzip.compress(FILL + SECRET, mtime=0)) + "\nNext line",
        base64.b64encode(gzip.compress(b"one", mtime=0) + gzip.compress(SECRET, mtime=0)).decode(),
        base64.b64encode(zlib.compress(b"one") + SECRET).decode(),
        base64.b64encode(b"x^ is no stream: " + SECRET).decode(),
        "".join(f"%{x:02x}" for x in gzip.compress(SECRET, mtime=0)),
        "".join(f"\\x{x:02x}" for x in zlib.compress(SECRET)),
        urllib.parse.quote(gzip.compress(FILL + SECRET, mtime=0), safe=""),
        urllib.parse.quote_plus(zlib.compress(FILL + SECRET)),
        repr(gzip.compress(FILL + SECRET, mtime=0)),
        "".join(f"%{x:02x}" for x in b"\xe9t\xe9 " + SECRET),
        "".join(f"\\u{ord(x):04x}" for x in "\ud800 " + SECRET.decode()),
    ],
)
def test_no_layer_is_thrown_away(coded):
    text = f"Seite äöü {coded} end"
    finds = {(a, b) for a, b, k in secrets.find(text)[1] if k == 0}
    assert finds and all(10 <= a < b <= 10 + len(coded) for a, b in finds)


def test_a_find_in_wrapped_base64_is_told_as_the_lines_that_hold_it():
    lines = wrapped(b"." * 57 + SECRET + b"." * 100).split("\n")
    assert secrets.find("\n".join(lines))[1] == [(77, 153, 0)]


def test_a_secret_that_an_escape_cuts_is_found_where_it_stands():
    text = "see token%3Dabcdefgh now"
    assert secrets.written(secrets.find(text)[1]) == "assign:4:20"


def test_large_streams_are_counted_and_not_unpacked():
    text = base64.b64encode(gzip.compress(b"a" * 100_000)).decode()
    assert secrets.find(text, most=1000)[3] == 1
    assert secrets.find("") == ([], [], 1, 0)


@pytest.mark.parametrize("at", [0, 40_000, 99_990, 199_000])
def test_large_streams_are_scanned_in_pieces(at):
    filler = bytes(random.Random(at).choices(b"ghijklmnop ", k=200_000))
    text = base64.b64encode(gzip.compress(filler[:at] + b" " + base64.b64encode(SECRET) + b" " + filler[at:], mtime=0)).decode()
    _, every, _, large = secrets.find(text, most=5000)
    assert every == [(0, len(text), 0)] and large == 1


def test_dual_coordinate_descent_separates_and_matches_a_gradient_check():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 200)
    rows = linear.Rows([np.unique(np.r_[rng.integers(2, 40, 6), 0 if v else 1]) for v in y], 40)
    w, b = quality.dual_coordinate_descent(rows, np.ones(40), y)
    margin = np.where(y > 0, 1, -1) * (rows.times(w) + b)
    assert (margin > 0).all()
    loss = lambda w, b: 0.5 * (w @ w + b * b) + 0.1 * np.maximum(0, 1 - np.where(y > 0, 1, -1) * (rows.times(w) + b)).sum()
    best = loss(w, b)
    assert all(loss(w + rng.normal(0, 0.02, 40), b) >= best - 1e-3 for _ in range(50))


def test_quality_model_tells_junk_from_prose():
    prose = ["The cat sat on the mat. It was warm, and it slept." * k for k in range(1, 20)]
    junk = ["BUY!! NOW!! BUY!! NOW!! " * k for k in range(1, 20)]
    model = quality.fit_texts(prose + junk, [1] * len(prose) + [0] * len(junk))
    assert model.score("The dog ran on the road. It was cold.") > 0.5 > model.score("WIN!! WIN!! WIN!! BIG!!")
    assert 0 <= model.score(None) <= 1 and model.score(None) == model.score("")
    assert quality.fit_texts([], []).score("x") == pytest.approx(0.5, abs=0.02)


def test_counterfactual_penalty_frees_neutral_mentions():
    rng = random.Random(4)
    neutral = [f"the {rng.choice(['river', 'house', 'garden', 'train'])} number{rng.randrange(50)} is near the town" for _ in range(150)]
    toxic = [f"you muslim idiot number{rng.randrange(50)} go away" for _ in range(60)] + [f"you idiot number{rng.randrange(50)} go away" for _ in range(20)]
    texts, y = neutral + toxic, [0] * len(neutral) + [1] * len(toxic)
    tied, free = toxicity.fit_texts(texts, y, penalty=20.0), toxicity.fit_texts(texts, y, groups=())
    mention = "the muslim house is near the town"
    assert tied.score(mention) < free.score(mention) and tied.score(mention) < 0.3
    assert tied.score("what an idiot") > 0.3
    assert abs(tied.margin("a muslim") - tied.margin("a jewish")) < abs(free.margin("a muslim") - free.margin("a jewish"))
    assert toxicity.swapped("nothing here", toxicity.IDENTITY_TERMS) == []


def test_raking_reaches_its_marginals():
    rng = np.random.default_rng(0)
    tokens = rng.integers(1, 1000, 60).astype(float)
    places = [np.arange(60) % 3, np.arange(60) // 3 % 4, np.arange(60) // 12]
    targets = [np.full(3, 1 / 3), np.array([0.1, 0.2, 0.3, 0.4]), np.full(5, 0.2)]
    w = mixing.rake(tokens, places, targets)
    for place, target in zip(places, targets, strict=True):
        assert np.allclose(np.bincount(place, w * tokens), target, atol=1e-6)
    p = mixing.probabilities(tokens, w, 0.4)
    assert (p <= 1).all() and (p * tokens).sum() == pytest.approx(0.4 * tokens.sum(), rel=1e-6)


def test_rare_word_prefixes_meet_for_every_similar_pair():
    rng = random.Random(9)
    hashes = WordHashes()
    for _ in range(300):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(5, 60))] + ["again"] * rng.choice([0, 0, 60, 150])
        b = list(a)
        for _ in range(rng.randrange(0, len(a) // 4 + 2)):
            b[rng.randrange(len(b))] = f"x{rng.randrange(30)}"
        if similar(" ".join(a), " ".join(b)):
            prefix = []
            for words in (a, b):
                marks, keys = labelled_words(hashes, words)
                rank = np.argsort(marks)  # any one order will do
                prefix.append(set(keys[rank[: len(words) - int(np.ceil(SIMILARITY * len(words) - 1e-9)) + 1]].tolist()))
            assert prefix[0] & prefix[1]


def test_sketches_agree_for_copies_and_near_copies_and_see_the_order():
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(320)]
    near = list(words)
    for k in (50, 150, 250):
        near[k] = "changed"
    moved = [w for at in range(280, -1, -40) for w in words[at : at + 40]]  # eight blocks, the last one first
    sketch = Sketcher().sketch
    a, b, c = (set(sketch(" ".join(w))) for w in (words, near, moved))
    assert a == set(sketch(" ".join(words).upper())) and len(a & b) > len(a) * 0.6 and len(a & c) < len(a) * 0.4
    assert sketch("") == [] and len(sketch("one two")) == sum(s for _, _, s, _ in FAMILIES) and sketch("a " * 3000)
    assert len(a) == FAMILIES[0][2]


def edited(rng, words, share, kinds):
    out = list(words)
    for _ in range(int(share * len(words) + 1e-9)):
        at, kind = rng.randrange(len(out)), rng.choice(kinds)
        out[at : at + (kind != "insert")] = [] if kind == "delete" else [f"x{rng.randrange(10**9)}"]
    return out


@pytest.mark.parametrize("kinds", [("replace",), ("replace", "insert", "delete")])
@pytest.mark.parametrize("n", [5, 6, 8, 12, 15, 16, 20, 40, 100, 159, 160, 200, 500])
def test_nine_of_ten_linked_pairs_share_a_sketch(n, kinds):
    """Recall by the stated link, for any length and as many edits as a link may have: texts of distinct words, the hardest case."""
    rng, sketch = random.Random(n), Sketcher().sketch
    for share in (0.1, 0.15, 0.2):
        linked = met = 0
        for _ in range(150):
            a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            x, y = " ".join(a), " ".join(edited(rng, a, share, kinds))
            if x != y and similar(x, y):
                linked += 1
                met += not set(sketch(x)).isdisjoint(sketch(y))
        assert met >= 0.9 * linked and linked >= 20 * (share * n >= 1)


@pytest.mark.parametrize("n", [60, 100, 160, 300, 700, 1000])
def test_recall_with_evenly_spaced_edits(n):
    """Every fifth word replaced, which leaves the fewest k-mers of two words that a link can have."""
    rng, sketch, met = random.Random(n), Sketcher().sketch, 0
    for _ in range(200):
        a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        b = list(a)
        for at in range(rng.randrange(5), n - n % 5, 5):
            b[at] = f"x{rng.randrange(10**9)}"
        assert similar(" ".join(a), " ".join(b))
        met += not set(sketch(" ".join(a))).isdisjoint(sketch(" ".join(b)))
    assert met >= 0.9 * 200


def test_archives_are_read_in_chunks_with_running_digests():
    body = bytes(range(256)) * 5000
    out = io.BytesIO()
    for kind, data, holder in (("response", body, None), ("revisit", b"", 7), ("response", b"", None)):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.write(pack.compress(warc.head(kind, 3, "http://x/\r\ny", hashlib.sha1(data).hexdigest(), len(data), len(data), holder) + data + b"\r\n\r\n") + pack.flush())
    out.seek(0)
    rows = list(warc.chunks(out, 1 << 16))
    first = [r for r in rows if r["fields"]["warc-type"] == "response" and r["size"]]
    assert b"".join(r["data"] for r in first) == body and max(len(r["data"]) for r in first) == 1 << 16
    assert [r["sha1"] for r in first] == [hashlib.sha1(body[: r["size"]]).hexdigest() for r in first]
    assert [r["chunk"] for r in first] == list(range(20)) and first[-1]["last"] and not first[0]["last"]
    assert sum(r["last"] for r in rows) == 3 and rows[-1]["sha1"] == hashlib.sha1().hexdigest()
    plain = io.BytesIO(warc.head("response", 1, "u", "d", 3, 3, None) + b"abc\r\n\r\n")
    assert [r["data"] for r in warc.chunks(plain)] == [b"abc"]
    with pytest.raises(EOFError):
        list(warc.chunks(io.BytesIO(warc.head("response", 1, "u", "d", 9, 9, None) + b"abc")))
    assert re.search(b"http://x/ y", warc.head("response", 3, "http://x/\r\ny", "", 0, 0, None))


def _packed(kind, data):
    import bz2
    import gzip
    import lzma

    if kind == "raw":
        raw = zlib.compressobj(9, zlib.DEFLATED, -15)
        return raw.compress(data) + raw.flush()
    return {"bz2": bz2.compress, "xz": lzma.compress, "gzip": gzip.compress, "zlib": zlib.compress}[kind](data)


SAID = "password = hunter2secret99 and more of it "
base64_text = lambda data: base64.b64encode(data).decode()
LAYERS = {
    **{e: base64_text(SAID.encode(e)) for e in ("utf-16-le", "utf-16-be", "utf-16", "utf-32-le", "utf-32-be", "utf-32")},
    **{k: base64_text(_packed(k, SAID.encode() * 3)) for k in ("raw", "bz2", "xz", "gzip", "zlib")},
    "zlib after a prefix": base64_text(b"head\0\1" + zlib.compress(SAID.encode())),
    "two streams of two kinds": base64_text(_packed("bz2", b"nothing") + b"--" + _packed("xz", SAID.encode())),
    "glued by 1": "x" + base64_text(SAID.encode()),
    "glued by 2": "ab" + base64_text(SAID.encode()),
    "glued by 3": "abc" + base64_text(SAID.encode()),
    "glued by a path": "data/" + base64_text(SAID.encode()),
    "slashes of JSON": base64_text(b"??>>??~~" + SAID.encode()).replace("/", "\\/"),
    "braces": "".join(f"\\u{{{ord(c):x}}}" for c in SAID),
    "eight digits": "".join(f"\\U{ord(c):08x}" for c in SAID),
    "octal": "".join(f"\\{ord(c):03o}" for c in SAID),
    "percent u": "".join(f"%u{ord(c):04x}" for c in SAID),
    "named entities": "password&equals;hunter2secret99",
    "entities without semicolon": "password&#61hunter2secret99",
    "a form": "password+%3D+hunter2secret99",
    "bz2 in base64 in base64": base64_text(("x " + base64_text(_packed("bz2", SAID.encode()))).encode()),
}


@pytest.mark.parametrize("name", sorted(LAYERS))
def test_layers_are_unwrapped(name):
    text = f"see {LAYERS[name]} there"
    base, every, layers, _ = secrets.find(text)
    assert not [x for x in base if "hunter2" in text[x[0] : x[1]]] or "hunter2" in LAYERS[name]
    assert layers > 1 and any(k == 0 and 4 <= a < b <= len(text) - 6 for a, b, k in every)


def test_bytes_that_are_no_stream_give_no_finds():
    rng = random.Random(2)
    for n in (20, 300, 5000):
        text = base64_text(rng.randbytes(n)) + " " + base64_text(b"BZh9" + rng.randbytes(n)) + " " + base64_text(b"\xfd7zXZ\0" + rng.randbytes(n)) + " " + base64_text(b"\x78\x9c" + rng.randbytes(n))
        assert secrets.find(text)[1] == secrets.find(text)[0]
