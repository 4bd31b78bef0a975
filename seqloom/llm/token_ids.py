"""Token ids of a corpus in binary shards whose document boundaries are Elias-Fano codes.

A shard holds documents in ascending order of doc_id:

    ids of all documents, one after another, little-endian, 2 bytes each where the vocabulary allows it and else 4
    an Elias-Fano block with the end of each document (in ids); one with the doc_ids
    footer: width of an id, offsets of the two blocks, number of ids, mark

Documents are dealt to shards by ranges of doc_id, so the shards in order are the corpus in order. A shard is written
as its rows arrive: one block of encoded texts is in memory at a time, besides the boundaries.
"""

from __future__ import annotations

import struct
import zlib
from itertools import accumulate
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import blocks, scratch
from .elias_fano import EliasFano
from .store import Writer, attempt_file, reader

FOOT = "<BQQQ4s"
FOOT_SIZE = struct.calcsize(FOOT)
END_ID = 2
CACHED_WORDS = 1_000_000
#: Marks that are tokens of their own after letters; the apostrophe, which some tokenizers join to letters, isn't one.
TAIL = ".,;:!?%*#$&|"
READ_IDS = 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class CachedTokenizer:
    """Encodes texts word by word and keeps the ids of words.

    That holds for tokenizers which drop white space, never join across it and mark the end of each word (start tries
    whether this one does, in split_by_space); any other gets whole texts.
    """

    def __init__(self, spec: str):
        self.spec = spec
        self.tok = None

    def __getstate__(self):
        return {"spec": self.spec}

    def __setstate__(self, state):
        self.__init__(**state)

    def start(self) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(self.spec)
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.cache: dict[str, bytes] = {}
        parts = json.loads(self.spec)
        names = [x.get("pattern", {}).get("Regex", "") for x in (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        plain = all(not (t["lstrip"] or t["rstrip"] or " " in t["content"]) for t in parts.get("added_tokens", []))
        close = (parts.get("model") or {}).get("end_of_word_suffix") or "</w>"
        self.closing = np.zeros(self.tok.get_vocab_size(), bool)
        self.closing[[k for t, k in self.tok.get_vocab().items() if t.endswith(close)]] = True
        self.split_by_space = plain and any("[^\\s" in x for x in names) and not self.ids(" \n") and self.ids("ab, b") == self.ids("ab") + self.ids(",") + self.ids("b")

        self.lean = self.tok
        if self.split_by_space and [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            # For composed letters alone, lower case and the model are all that is left to do.
            parts["normalizer"] = {"type": "Lowercase"}
            byte_level = [x for x in parts["pre_tokenizer"]["pretokenizers"] if x.get("type") == "ByteLevel"]
            parts["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *byte_level]}
            self.lean = Tokenizer.from_str(json.dumps(parts))

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        """Encodes new words: letters many at a time, punctuation after letters by itself, and any other word alone."""
        cache, plain, tailed, alone = self.cache, [], [], []
        for w in words:
            if "\u0130" in w:  # the one letter that lower case gives a mark, which goes with what follows
                alone.append(w)
            elif w.isalpha():
                plain.append(w)
            elif (core := w.rstrip(TAIL)).isalpha() and (core.isascii() or normalize("NFC", core)[-1].isalpha()):
                tailed.append((w, core))  # letters that NFC ends with a mark go with what follows them
            else:
                alone.append(w)
        plain = list(dict.fromkeys(plain + [core for _, core in tailed if core not in cache]))
        width = np.dtype(self.dtype).itemsize
        for at in range(0, len(plain), 2000):
            part = plain[at : at + 2000]
            joined = " ".join(part)
            tok = self.lean if is_normalized("NFC", joined) else self.tok
            ids = np.array(tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) != len(part):  # lower case made more than letters of a word
                alone += part
                continue
            raw, cuts = ids.astype(self.dtype).tobytes(), [0, *(ends * width).tolist()]
            cache.update((w, raw[a:b]) for w, a, b in zip(part, cuts, cuts[1:], strict=False))
        for w in alone:
            cache[w] = np.array(self.ids(w), self.dtype).tobytes()
        for w, core in tailed:
            tail = w[len(core) :]
            if tail not in cache:
                cache[tail] = np.array(self.ids(tail), self.dtype).tobytes()
            cache[w] = cache[core] + cache[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes in the order of the machine-independent file."""
        if self.tok is None:
            self.start()
        if not self.split_by_space:
            return [np.array(self.ids(t), self.dtype).tobytes() for t in texts]
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = set().union(*split)
        self.learn(sorted(new))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]


def write_shards(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, folder: str | None = None, shards: int | None = None) -> list[dict]:
    """Writes docs (doc_id, text) and returns a row for each shard, in order: path, first and number of documents and ids.

    shards: as many ranges of doc_id; by default those of the session or of the input's own partitions, whichever
    are more, so that a shard stays about as large as an input split. Rows without a doc_id come first.
    """
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(CachedTokenizer(f.read()))
    folder = folder or scratch(spark, "token-ids")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    schema = pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches):
        out, path, ends, doc_ids, end = None, None, [], [], np.array([end_id])
        tok = sent.value
        for ids, texts in blocks(batches, 2_000_000):
            if out is None:
                out = Writer(path := attempt_file(folder, ".ids"))
            coded = tok.encode(texts)
            tail = end.astype(tok.dtype).tobytes()
            width = len(tail)
            out.write(b"".join(x for c in coded for x in (c, tail)))
            ends.extend(len(c) // width + 1 for c in coded)
            doc_ids.extend(ids)
        if out is not None:
            n = sum(ends)
            at = out.size
            out.write(EliasFano.encode(np.fromiter(accumulate(ends), np.int64, len(ends))).dump())
            mid = out.size
            out.write(EliasFano.encode(np.array(doc_ids, np.int64)).dump())
            out.write(struct.pack(FOOT, width, at, mid, n, b"TOKS"))
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "first_id": doc_ids[0], "n_docs": len(ends), "n_ids": n}], schema=schema)

    spread = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    done = spread.mapInArrow(write, "path string, first_id long, n_docs long, n_ids long").collect()  # a row for each shard
    return [x.asDict() for x in sorted(done, key=lambda x: x["first_id"])]


class Shard:
    """One shard, open for reading; ids(k) are the ids of its document k."""

    def __init__(self, path: str):
        self.file = reader(path)
        size = self.file.size()
        self.width, at, mid, self.n_ids, mark = struct.unpack(FOOT, self.file.read_at(FOOT_SIZE, size - FOOT_SIZE))
        if mark != b"TOKS":
            raise ValueError(f"{path} is not a shard of token ids")
        self.ends = EliasFano.load(self.file.read_at(mid - at, at))
        self.doc_ids = EliasFano.load(self.file.read_at(size - FOOT_SIZE - mid, mid))

    def __len__(self) -> int:
        return self.ends.n

    def bounds(self, k: int) -> tuple[int, int]:
        return (self.ends.select(k - 1) if k else 0), self.ends.select(k)

    def read(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - begin) * self.width, begin * self.width), f"<u{self.width}")

    def ids(self, k: int) -> np.ndarray:
        return self.read(*self.bounds(k))


def read_documents(spark, manifest: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read from the shards, one task for each."""
    starts = list(accumulate((x["n_ids"] for x in manifest), initial=0))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                for at in range(0, len(shard), 4096):
                    ends = shard.ends.values(at, at + 4096)
                    begins = np.concatenate([[shard.ends.select(at - 1) if at else 0], ends[:-1]])
                    crcs = []
                    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                        crc = 0
                        for k in range(a, b, READ_IDS):
                            crc = zlib.crc32(shard.read(k, min(b, k + READ_IDS)).astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    keys = shard.doc_ids.values(at, at + 4096)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, mask=keys == -(1 << 62)), pa.array(begins + row["start"], pa.int64()), pa.array(ends - begins, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], out)
    table = spark.createDataFrame([(x["path"], s) for x, s in zip(manifest, starts, strict=False)], "path string, start long")
    return table.repartition(len(manifest)).mapInArrow(run, out)


def encode_corpus(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes the shards of docs (doc_id, text) and reads every document back from them; a null text counts as an empty one."""
    return read_documents(docs.sparkSession, write_shards(docs, vocabulary))


def op9_token_ids(spark, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to shards and read back.

    A null text counts as empty and so has the end id alone; repeated rows (also of one doc_id) are documents of their
    own, in the order of their texts' hashes; rows without a doc_id come first, with a null doc_id; an empty table gives
    none. Very long texts are encoded whole, each as a block of its own. Other columns are never read.
    """
    return encode_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
