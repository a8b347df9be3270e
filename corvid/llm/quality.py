"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one for each word, one for
each character 3- and 4-gram of the words, and one for each of a few style
words made from the whole text (share of distinct words, of repeated
lines, of capitals, of symbols), all hashed into BUCKETS rows.  A softmax
over the average gives the probability of label 1.  Numpy trains it by
stochastic gradient descent on at most ``sample_rows`` labelled documents
(a bounded sample, by hash of doc_id), whole texts of each.

As the softmax of an average is linear in the vectors, scoring needs one
number for each bucket; a word's share is computed once in a task.

Defined cases: null and empty texts are scored as a text without words;
labels that are null, neither 0 nor 1, or of unknown documents teach
nothing; a doc_id labelled twice counts once, with the smaller label; with
no labels every score is 0.5; a null doc_id is not held out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches
from corvid.llm.language_id import held_out

BUCKETS, DIM, EPOCHS, RATE, SEED = 1 << 17, 16, 4, 0.5, 9
#: The style words weigh as much as this share of the other features.
STYLE = 0.25
_WORDS_KEPT = 400_000


def word_features(word: str) -> list[int]:
    b = f"<{word}>".encode()
    grams = [b, *(b[i : i + n] for n in (3, 4) for i in range(len(b) - n + 1))]
    return [zlib.crc32(g) % BUCKETS for g in grams]


def style_features(text: str, words: list[str]) -> list[int]:
    lines = [x for x in text.split("\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(text))
    upper = sum(w.isupper() for w in words)
    symbols = sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" for w in words)
    names = (
        f"\0distinct {10 * len(set(words)) // n}/{n.bit_length()}",
        f"\0lines {10 * len(set(lines)) // max(1, len(lines))}",
        f"\0upper {10 * upper // n}",
        f"\0symbols {10 * symbols // n}",
        f"\0words {n.bit_length() if words else 0}",
        f"\0word {min(30, chars // n)}",
    )
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


def _train(samples: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """The number of each bucket, and the bias, of the log odds of label 1."""
    rng = np.random.default_rng(SEED)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    cached: dict[str, list[int]] = {}
    docs = []
    for text, label in samples:
        words, ids = text.split(), []
        for w in words:
            ids += cached.get(w) or cached.setdefault(w, word_features(w))
        u, c = np.unique(np.array(ids, np.int32), return_counts=True)
        s = np.array(style_features(text, words), np.int32)
        total = max(1, len(ids))
        docs.append((np.concatenate([u, s]), np.concatenate([c / total * (1 - STYLE), np.full(len(s), STYLE / len(s))]).astype(np.float32), label))
    share = np.bincount([y for _, _, y in docs], minlength=2) / max(1, len(docs))
    weight = 0.5 + 0.25 / np.maximum(share, 0.05)  # the rarer label counts more, but not as much as the other in all
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            ids, w, y = docs[k]
            h = w @ vec[ids]
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = RATE * (1 - epoch / EPOCHS) * weight[y] * p
            # the step of a vector is spread over its share of the document, as in an average, but not shrunk by the document's length
            np.add.at(vec, ids, -np.outer(np.minimum(1, w * 8), g @ out).astype(np.float32))
            out -= np.outer(g, h)
            bias -= g * 0.1
    return (vec @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", sample_rows: int = 4000) -> tuple[np.ndarray, float]:
    """A model from the labelled documents that are not held out (crc32(doc_id) mod 5 is not 0)."""
    y = labels.select(F.col("doc_id").alias("i"), F.col(target).cast("int").alias("y")).where("i is not null and y in (0, 1)")
    y = y.where(~held_out("i", 5, 0)).groupBy("i").agg(F.min("y").alias("y"))
    known = docs.select(F.col("doc_id").alias("i")).distinct()
    chosen = y.join(known, "i", "left_semi").orderBy(F.xxhash64("i"), "i").limit(sample_rows)
    rows = docs.select(F.col("doc_id").alias("i"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    # sample_rows bounds the broadcast and the one group
    sample = rows.join(F.broadcast(chosen), "i").groupBy("i").agg(F.min("t").alias("t"), F.min("y").alias("y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        table, bias = _train(list(zip(pdf["t"], pdf["y"].astype(int), strict=True)))
        return pd.DataFrame({"table": [table.tobytes()], "bias": [bias]})

    got = sample.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(fit, "table binary, bias double").collect()
    return (np.frombuffer(got[0].table, np.float32), got[0].bias) if got else (np.zeros(BUCKETS, np.float32), 0.0)


_cache: dict[int, tuple[dict[str, int], list[float], list[int]]] = {}


def predict(model: tuple[np.ndarray, float]):
    """A column function from text to the probability of label 1."""
    table, bias = model
    name = zlib.crc32(table.tobytes())

    def places(words: list[str], held: tuple) -> np.ndarray:
        at, sums, counts = held
        for w in set(words).difference(at):
            f = word_features(w)
            at[w] = len(sums)
            sums.append(float(table[f].sum()))
            counts.append(len(f))
        return np.fromiter(map(at.__getitem__, words), np.int64, len(words))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _cache:
            _cache.clear()
            _cache[name] = ({}, [], [])
        for texts in batches:
            out = []
            for t in texts:
                t = t or ""
                words = t.split()
                if len(_cache[name][0]) > _WORDS_KEPT:
                    _cache[name] = ({}, [], [])
                own, total = 0.0, 1
                if words:
                    k, n = np.unique(places(words, held := _cache[name]), return_counts=True)
                    own = sum(held[1][i] * c for i, c in zip(k.tolist(), n.tolist(), strict=True))
                    total = sum(held[2][i] * c for i, c in zip(k.tolist(), n.tolist(), strict=True))
                s = table[style_features(t, words)].mean(dtype=float)
                out.append(own / total * (1 - STYLE) + s * STYLE + bias)
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -50, 50))))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    score = predict(learn(docs, labels, "quality", sample_rows))
    rows = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
