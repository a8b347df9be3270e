"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1.  A letter trigram is
the product of its letters' vectors, the first rotated by two places and
the second by one (permute and bind).  A document is the sum of its
trigrams (bundle); a language's prototype is the sum of the unit vectors
of its training documents.  The prediction is the prototype of largest
cosine.

Defined cases: a null text or one without a letter is ``und`` with score 0,
as is every text when nothing was learned; equal cosines go to the
alphabetically first language; a null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, giving_back, slices

#: Places of a vector, and the symbols: 0 is "no letter", a to z have a
#: symbol of their own, other letters share the rest by code point.
DIM, SYMBOLS, SEED = 1024, 128, 20
#: Texts of fewer letters are not judged by their cosine.
SHORT = 24


@cache
def _symbols() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            low = ord(chr(cp).lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the symbols as first, second and third letter of a trigram."""
    v = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIM))
    return np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v


def _bundles(texts: list[str]) -> np.ndarray:
    """The vector of every text; zeros for a text without letters."""
    cps = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    sym = _symbols()[cps]
    inside = np.flatnonzero(sym)  # a trigram for each letter, in its middle; words have a 0 at either end
    doc = doc[inside]
    padded = np.concatenate([[0], sym, [0]]).astype(np.int32)
    tri = (padded[inside] * SYMBOLS + padded[inside + 1]) * SYMBOLS + padded[inside + 2]
    seen = np.zeros(SYMBOLS**3, bool)
    seen[tri] = True
    used = np.flatnonzero(seen)
    place = np.zeros(SYMBOLS**3, np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(texts), DIM), np.float32)
    if not len(used):
        return out
    step = max(1, (4 << 20) // len(used))
    first, second, third = _letters()
    at = place[tri]
    bounds = np.searchsorted(doc, np.arange(0, len(texts) + step, step))
    for k in range(len(bounds) - 1):
        lo, n = k * step, min(step, len(texts) - k * step)
        if n <= 0:
            break
        part = slice(bounds[k], bounds[k + 1])
        counts = np.bincount((doc[part] - lo) * len(used) + at[part], minlength=n * len(used)).reshape(n, -1).astype(np.float32)
        for i in range(0, len(used), 4096):
            u = used[i : i + 4096]
            v = first[u // SYMBOLS**2] * second[u // SYMBOLS % SYMBOLS] * third[u % SYMBOLS]
            out[lo : lo + n] += counts[:, i : i + 4096] @ v.astype(np.float32)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def vectors(texts: list[str]) -> Iterator[np.ndarray]:
    """Unit vectors of the texts, in blocks of bounded size."""
    for a, b in slices(texts, 1 << 18):
        yield _unit(_bundles(texts[a:b]))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes from the rows of ``docs`` with a label.

    Tasks add up their own documents, Spark adds up the tasks by language
    and place; the driver gets DIM numbers for each language.
    """
    bounded_batches(docs.sparkSession)

    @giving_back
    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            texts, langs, at = pdf["t"].tolist(), pdf["l"].to_numpy(), 0
            for v in vectors(texts):
                own = langs[at : at + len(v)]
                for k in set(own):
                    total[k] = total.get(k, 0) + v[own == k].sum(0, dtype=np.float64)
                at += len(v)
        yield pd.DataFrame({"lang": list(total), "v": [x.tolist() for x in total.values()]}, dtype=object)

    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    sums = rows.mapInPandas(bundle, "lang string, v array<double>").select("lang", F.posexplode("v").alias("place", "x"))
    out: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang", "place").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r.lang, np.zeros(DIM))[r.place] = r.x
    return {k: out[k] for k in sorted(out) if out[k].any()}


def predict(prototypes: dict[str, np.ndarray]):
    """A column function from text to struct(lang_pred, score)."""
    names = [*prototypes, "und"]
    protos = _unit(np.array([*prototypes.values()]).reshape(-1, DIM)).astype(np.float32)

    @F.pandas_udf("lang_pred string, score double")
    @giving_back
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            best, score = [], []
            for v in vectors([t or "" for t in texts]):
                cos = v @ protos.T if len(protos) else np.zeros((len(v), 1), np.float32)
                k = cos.argmax(1)
                top = cos[np.arange(len(v)), k].astype(float)
                none = ~v.any(1) | (len(protos) == 0)
                best.append(np.where(none, len(names) - 1, k))
                score.append(np.where(none, 0.0, top.clip(0, 1)))
            yield pd.DataFrame({"lang_pred": [names[k] for x in best for k in x], "score": np.concatenate(score) if score else np.zeros(0)})

    return classify


def held_out(doc_id: str, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learns from the rows whose crc32(doc_id) mod 4 is not 2.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    classify = predict(learn(rows.where(~held_out("doc_id", 4, 2))))
    return rows.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), classify("text").alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least: float = 0.05) -> DataFrame:
    """The rows of ``docs`` whose language is known with a cosine of ``least`` or more.

    A text under SHORT letters has too few trigrams for the cosine to tell
    a language from noise (1 / sqrt(DIM)); only those without a language go.
    """
    bounded_batches(docs.sparkSession)
    classify = predict(learn(docs.where(~held_out("doc_id", 4, 2))))
    p = "__language_id"
    return docs.withColumn(p, classify("text")).where((F.col(f"{p}.lang_pred") != "und") & ((F.col(f"{p}.score") >= least) | (F.char_length(F.regexp_replace("text", r"\P{L}+", "")) < SHORT))).drop(p)
