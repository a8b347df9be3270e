"""Token counts by a digest cache.

A text's key is the SHA-256 of its normalised content: what the tokenizer
sees, so that texts of equal keys have equal counts.  For sentencepiece
models a space and U+2581 are the same symbol, so the latter becomes a space;
for other tokenizers the content is the text itself.  A tokenizer's version
is the SHA-256 of its file, its library's version and the way of counting.

The cache is a folder of Parquet rows (digest, n_tokens) in subfolders
``version=...`` and below these ``batch=...``.  A call

1. reads the documents for their keys and byte lengths, and joins the distinct
   keys with the counts stored under this version;
2. takes one text of each key without a count (copies meet in a map-side
   aggregation, so a hot text is shuffled once for each task) and encodes it;
3. appends the new counts as a batch folder of its own, which no other writer
   touches; every stored row is true by itself, so a batch that was cut short
   only leaves more to encode;
4. joins the documents' keys with the counts.

Encoding looks up words: where no piece of the vocabulary has a space inside,
no merge crosses from a word to the space after it, and a text's count is the
sum of those of its words with the spaces before them.  Where that does not
hold, or a text has runs of spaces, the library encodes the whole text.

Defined cases: a null text counts as empty; an empty text has no bytes and no
tokens; a null doc_id is a row like any other; repeated rows and texts that
occur often give a row each and are encoded once; an empty table gives none
and appends nothing; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, scratch_dir, slices, written

LIMIT = 4096
#: Words whose counts a task remembers, and the longest of these.
_WORDS_KEPT, _WORD_CHARS = 200_000, 64
_SPACE = "▁"  # fixed value: the space of sentencepiece's pieces
_CACHE = "digest binary, n_tokens long, version string, batch string"


def version(path: str) -> str:
    """Digest of a tokenizer's file, its library's version and the way of counting."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(b"\0".join([f.read(), library.__name__.encode(), library.__version__.encode(), b"whole texts, none added"])).hexdigest()


def _digest(text: Column, path: str) -> Column:
    own = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.translate(own, _SPACE, " ") if path.endswith(".model") else own, 256))


class _Sentencepiece:
    """Counts of a sentencepiece model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        n, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
        as_is = n.name == "identity" and not n.precompiled_charsmap and n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces
        whole = all(_SPACE not in p.piece.lstrip(_SPACE) and p.type != kinds.USER_DEFINED for p in proto.pieces)
        self.by_word = as_is and whole and proto.trainer_spec.model_type == pb.TrainerSpec.BPE and not proto.trainer_spec.treat_whitespace_as_suffix
        self.words: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        plain = [self.by_word and t != "" and t[0] not in (" ", _SPACE) and t[-1] not in (" ", _SPACE) and "  " not in t and _SPACE not in t for t in texts]
        odd = [i for i, p in enumerate(plain) if not p]
        out[odd] = self.whole([texts[i] for i in odd])
        own = np.flatnonzero(plain)
        if not len(own):
            return out
        split = pc.split_pattern(pa.array([texts[i] for i in own], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > _WORDS_KEPT:
            self.words.clear()
            new = words
        got = dict(zip(new, self.whole(new), strict=True))
        counts = np.fromiter((got[w] if w in got else self.words[w] for w in words), np.int64, len(words))
        self.words.update((w, n) for w, n in got.items() if len(w) <= _WORD_CHARS)
        total = np.concatenate([[0], np.cumsum(counts[coded.indices.to_numpy()])])
        ends = split.offsets.to_numpy()
        out[own] = total[ends[1:]] - total[ends[:-1]]
        return out


class _Tokenizers:
    """Counts of a file of the tokenizers library, its defaults but for truncation and padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.array([len(x.ids) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)], np.int64)


_counters: dict[str, Callable[[list[str]], np.ndarray]] = {}


def _counter(path: str) -> Callable[[list[str]], np.ndarray]:
    if path not in _counters:
        _counters[path] = (_Sentencepiece if path.endswith(".model") else _Tokenizers)(path)
    return _counters[path]


def stored(spark: SparkSession, cache: str, own: str) -> DataFrame:
    """(digest, n_tokens) of a version in the cache; batches of writers that ran side by side may repeat a row."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={own}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(_CACHE).parquet(cache).where(F.col("version") == own)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``tokenizer`` is a path that all machines have (``.json`` of tokenizers,
    ``.model`` of sentencepiece); ``cache`` a folder that they share, a fresh
    one where none is given.  Special strings in texts are handled as the
    library's default has it; nothing is added, cut or padded.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    cache = (cache or scratch_dir(spark, "token-cache")).rstrip("/")
    own = version(tokenizer)
    digest = _digest(F.col("text"), tokenizer).alias("digest")
    keys = written(docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), digest), "text-keys")
    known = written(keys.select("digest").distinct().join(stored(spark, cache, own), "digest", "left"), "known-counts")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(tokenizer)
        for pdf in batches:
            texts = pdf["text"].tolist()
            n = [count(texts[a:b]) for a, b in slices(texts, 1 << 20)]
            yield pd.DataFrame({"digest": pdf["digest"], "n_tokens": np.concatenate(n) if n else np.zeros(0, np.int64)})

    fresh = known.where("n_tokens is null").select("digest")
    hits = known.where("n_tokens is not null")
    if not fresh.isEmpty():
        texts = docs.select(digest, F.coalesce("text", F.lit("")).alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
        new = texts.join(fresh, "digest", "left_semi").mapInPandas(encode, "digest binary, n_tokens long")
        place = f"{cache}/version={own}/batch={uuid.uuid4().hex}"
        new.write.parquet(place)
        hits = hits.union(spark.read.schema("digest binary, n_tokens long").parquet(place))
    got = keys.join(hits, "digest")
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
