"""Language identification with unigram piece models, summed over all segmentations.

A word is cut into pieces of a fixed public vocabulary in many ways. Each language has a probability for each piece;
the probability of a word is the sum over its segmentations, found with a forward pass, and a text is the product of
its words. The piece probabilities come from expectation-maximisation (forward-backward) on a bounded sample of
labelled texts. Forward passes run over all new words of a batch at once in numpy and are kept by word.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import blocks, bounded_sample, id_bucket

WORD = re.compile(r"[^\W\d_]+")
#: Words longer than this go through the pass that rescales as it goes.
LONG = 48
#: A probability is carried times this to the power of the piece's length; the factor is the same for all languages.
SCALE = 16.0
CACHED_WORDS = 250_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[str]:
    """The pieces which lower-cased words (with a mark at their start) can contain; id 0 stands for an unknown letter."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return ["<unk>", *(p for p in every if p == p.lower() and re.fullmatch(r"▁?[^\W\d_]*", p) and p)]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class PieceModel:
    """langs: names. probs: pieces x languages. Both are plain arrays, so the model can be sent to executors."""

    def __init__(self, pieces: list[str], langs: list[str], probs: np.ndarray | None = None):
        self.pieces, self.langs = pieces, langs
        self.most = max(map(len, pieces[1:]), default=1)
        self.size = np.array([1, 1, *map(len, pieces[1:])], float)
        # row 0: no piece; row 1: the unknown letter; then the pieces
        self.index = {p: i + 1 for i, p in enumerate(pieces) if i}
        self.table = None if probs is None else self._scaled(probs)
        self.cache: dict[str, int] = {}
        self.scores = np.zeros((1024, len(langs)))

    def __getstate__(self):
        return {"pieces": self.pieces, "langs": self.langs, "table": self.table}

    def __setstate__(self, state):
        self.__init__(state["pieces"], state["langs"])
        self.table = state["table"]

    def _scaled(self, probs: np.ndarray) -> np.ndarray:
        table = np.zeros((len(self.pieces) + 1, probs.shape[1]))
        table[1:] = probs * (SCALE ** self.size[1:])[:, None]
        return table

    def lattice(self, words: list[str], n: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Piece rows of all spans of words that have n letters, the mark included."""
        spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - self.most), j)]
        get = self.index.get
        flat = [get(w[i:j], 1 if j - i == 1 else 0) for w in words for i, j in spans]
        return np.array(flat, np.int32).reshape(len(words), len(spans)), spans

    def forward(self, ids: np.ndarray, spans: list[tuple[int, int]], n: int, table: np.ndarray) -> np.ndarray:
        alpha = np.zeros((n + 1, len(ids), table.shape[1]))
        alpha[0] = 1
        for k, (i, j) in enumerate(spans):
            alpha[j] += alpha[i] * table[ids[:, k]]
        return alpha

    def long_word(self, word: str) -> np.ndarray:
        """The same sum for a word of any length, with the running values of each language rescaled at each letter."""
        get, table, total = self.index.get, self.table, np.zeros(len(self.langs))
        recent = [np.ones(len(self.langs))]  # of the last positions, latest last
        for j in range(1, len(word) + 1):
            here = sum(recent[-size] * table[get(word[j - size : j], 1 if size == 1 else 0)] for size in range(1, min(j, self.most) + 1))
            recent = [x / here for x in recent[-self.most :]] + [np.ones(len(self.langs))]
            total += np.log(here)
        return total

    def expect_long(self, word: str, table: np.ndarray, weight: float, expected: np.ndarray) -> None:
        """Adds how often each piece is expected in a word of any length, by sums of logarithms from both of its ends."""
        with np.errstate(divide="ignore"):
            logs = np.log(table)
        get, n = self.index.get, len(word)
        rows = [np.array([get(word[j - size : j], 1 if size == 1 else 0) for size in range(1, min(j, self.most) + 1)]) for j in range(n + 1)]
        alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[0] = beta[n] = 0
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce(alpha[j - len(rows[j]) : j][::-1] + logs[rows[j]])
        for j in range(n, 0, -1):
            span = slice(j - len(rows[j]), j)
            through = logs[rows[j]][::-1] + beta[j]
            beta[span] = np.logaddexp(beta[span], through)
            np.add.at(expected, rows[j][::-1], weight * np.exp(alpha[span] + through - alpha[n]))

    def learn_words(self, words: list[str]) -> None:
        """Puts the log-probabilities of new words into the cache."""
        if len(self.cache) + len(words) > CACHED_WORDS:
            self.cache.clear()
        by_size = defaultdict(list)
        for w in words:
            by_size[len(w) + 1].append(w)
        for n, group in by_size.items():
            for at in range(0, len(group), 2000):
                part = group[at : at + 2000]
                marked = ["▁" + w for w in part]
                if n > LONG:
                    found = np.array([self.long_word(w) for w in marked])
                else:
                    ids, spans = self.lattice(marked, n)
                    found = np.log(self.forward(ids, spans, n, self.table)[n])
                first = len(self.cache)
                need = first + len(part)
                if need > len(self.scores):
                    self.scores = np.concatenate([self.scores, np.zeros((max(need, len(self.scores)), len(self.langs)))])
                self.scores[first:need] = found
                self.cache.update(zip(part, range(first, need), strict=True))

    def text_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of the words for each language, up to one constant."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            new = [w for w in dict.fromkeys(part) if w not in self.cache]
            if new:
                self.learn_words(new)
                if any(w not in self.cache for w in part):  # the cache was emptied in between
                    self.learn_words([w for w in dict.fromkeys(part) if w not in self.cache])
            total += self.scores[[self.cache[w] for w in part]].sum(0)
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """A language and its posterior probability for each text; their new words are learnt together."""
        split = [words_of(t) if t else [] for t in texts]
        new = {w for words in split for w in words if w not in self.cache}
        if len(new) < CACHED_WORDS // 2:
            self.learn_words(list(new))
        out = []
        for words in split:
            if not self.langs or not any(c.isalpha() for w in words for c in w):
                out.append(("und", 0.0))
                continue
            total = self.text_scores(words)
            best = int(total.argmax())
            out.append((self.langs[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())))
        return out


def train(samples: dict[str, list[str]], pieces: list[str], rounds: int = 3, smooth: float = 0.05) -> PieceModel:
    """EM for each language on its sample texts."""
    langs = sorted(samples)
    model = PieceModel(pieces, langs)
    probs = np.zeros((len(pieces), len(langs)))
    for c, lang in enumerate(langs):
        counts = Counter(w for text in samples[lang] for w in words_of(text))
        groups = defaultdict(list)
        for w in counts:
            groups[len(w) + 1].append(w)
        long = [w for n in list(groups) if n > LONG for w in groups.pop(n)]
        lattices = []
        for n, words in groups.items():
            ids, spans = model.lattice(["▁" + w for w in words], n)
            lattices.append((n, ids, spans, np.array([counts[w] for w in words], float)))
        here = np.full((len(pieces), 1), 1 / len(pieces))
        for _ in range(rounds):
            table, expected = model._scaled(here), np.zeros(len(pieces) + 1)
            for n, ids, spans, weight in lattices:
                alpha = model.forward(ids, spans, n, table)[:, :, 0]
                beta = np.zeros_like(alpha)
                beta[n] = 1
                for k in range(len(spans) - 1, -1, -1):
                    i, j = spans[k]
                    beta[i] += table[ids[:, k], 0] * beta[j]
                for k, (i, j) in enumerate(spans):
                    share = weight * alpha[i] * table[ids[:, k], 0] * beta[j] / np.maximum(alpha[n], 1e-300)
                    expected += np.bincount(ids[:, k], share, len(expected))
            for w in long:
                model.expect_long("▁" + w, table[:, 0], counts[w], expected)
            here = (expected[1:] + smooth)[:, None]
            here /= here.sum()
        probs[:, c] = here[:, 0]
    model.table = model._scaled(probs)
    return model


def fit(labelled: DataFrame, vocabulary: str | None = None, per_lang: int = 300) -> PieceModel:
    """Learns from at most per_lang texts of each language in labelled (doc_id, text, lang)."""
    pieces = read_pieces(vocabulary or default_vocabulary())
    texts = defaultdict(list)
    for lang, _, text in bounded_sample(labelled.where("text is not null"), labelled, "doc_id", "lang", per_lang, of_value=True):
        texts[lang].append(text)
    return train(texts, pieces)


def identify(docs: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, lang_pred, score of each row of docs (doc_id, text); `und` and 0 for a text that is null or has no letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        for ids, texts in blocks(batches):
            found = sent.value.predict(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows whose id bucket modulo 4 isn't 2.

    Null, empty or letterless texts give `und` with score 0; very long ones are scored whole, as a block of their own, and
    very long words with rescaling; of languages that tie the first in the alphabet is taken. Repeated rows each give a
    row, and rows without a doc_id are never learnt from. An empty table gives none; with no labelled row at all every
    text is `und`. Other columns of the table are never read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(id_bucket("doc_id", 4) != 2))
    found = identify(docs, model)
    return found.select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
