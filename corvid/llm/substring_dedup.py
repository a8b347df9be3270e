"""Substring dedup by sliding sentence spans.

A text is cut into units: sentences (ending in . ! ? or a line's end), and
pieces of those over ``piece_words`` words.  Of any ``piece_words`` places
between words in a row, a piece ends at the one of smallest hash (of the
words on both sides; the last of equals).  So no unit is longer than that,
and the units of a shared passage are the same in every document from its
first ``piece_words`` words at most to its last ``piece_words`` at most,
wherever in a sentence it begins and ends: with 12, any passage of 51 words
has 27 words, or more, of equal units in a row, which hold a span.  From each
unit starts a
span: ``run`` consecutive units, and more until it has ``least_words``
words.  Spans are compared without regard to case and white space, by a
128-bit hash, over all documents; the first of equal spans (smallest
doc_id, then text, then place) stays, and units covered by any other span
go.

Defined cases: null and empty texts have no span and stay as they are; a
text with fewer words than a span stays; repeated rows (same doc_id and
text) are one document and stay both; a null doc_id is first; a document
whose units all go keeps its row with an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, giving_back, text_key, written

RUN, LEAST_WORDS, PIECE_WORDS = 3, 24, 12
_WORD = re.compile(r"\S+\s*")


def _places(words: list[str], window: int) -> list[int]:
    """The places (words before them) where a long sentence is cut."""
    h = [xxhash.xxh3_64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:])]
    out, at = [], -1
    for end in range(window - 1, len(h)):
        start = end - window + 1
        if at < start:
            held = h[start : end + 1]
            held.reverse()
            at = end - held.index(min(held))
        elif h[end] <= h[at]:
            at = end
        else:
            continue
        out.append(at + 1)
    return out


def units(text: str, piece_words: int = PIECE_WORDS) -> list[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of each unit that has words; each unit owns the white space after it."""
    cuts, at = [], 0
    for m in re.finditer(r"[.!?]+\s+|\s*\n\s*", text):
        cuts.append((at, m.end()))
        at = m.end()
    cuts.append((at, len(text)))
    out = []
    for a, b in cuts:
        words = text[a:b].lower().split()
        if len(words) <= piece_words:
            if words:
                out.append((a, b, words))
            continue
        ends = [m.end() for m in _WORD.finditer(text, a, b)]
        start, first = a, 0
        for k in [*_places(words, piece_words), len(words)]:
            out.append((start, ends[k - 1], words[first:k]))
            start, first = ends[k - 1], k
    return out


def spans(text: str, run: int = RUN, least_words: int = LEAST_WORDS, piece_words: int = PIECE_WORDS) -> list[tuple[int, int, int, int]]:
    """(first unit, number of units, hash, hash) of every span of a text."""
    own = [w for _, _, w in units(text, piece_words)]
    joined, out, end, held = [" ".join(w) for w in own], [], 0, 0
    for k in range(len(own)):
        while end < len(own) and (end - k < run or held < least_words):
            held += len(own[end])
            end += 1
        if end - k < run or held < least_words:
            break
        h = xxhash.xxh3_128_intdigest(" ".join(joined[k:end]))
        out.append((k, end - k, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)))
        held -= len(own[k])
    return out


def cut(text: str, covered: list[tuple[int, int]], piece_words: int = PIECE_WORDS) -> str:
    """``text`` without the units of the given (first, number) spans."""
    own = units(text, piece_words)
    gone = set()
    for k, n in covered:
        gone.update(range(k, k + n))
    if not gone:
        return text
    return "".join(text[a:b] for k, (a, b, _) in enumerate(own) if k not in gone).strip()


def repeats(docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(doc_id, key, covered) for each document that has a non-first repeated span."""
    spark = docs.sparkSession
    bounded_batches(spark)

    @giving_back
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, k, *s) for i, k, t in zip(pdf["i"], pdf["k"], pdf["t"], strict=True) for s in spans(t, run, least_words, piece_words)]
            yield pd.DataFrame(out, columns=["i", "k", "at", "n", "h1", "h2"])

    i_type = docs.schema["doc_id"].dataType
    rows = docs.where("text is not null").select(F.col("doc_id").cast("string").alias("i"), text_key(F.col("text")).alias("k"), F.col("text").alias("t"))
    found = rows.mapInPandas(hashed, "i string, k long, at int, n int, h1 long, h2 long").withColumn("i", F.col("i").cast(i_type))
    found = written(found, "spans")
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("i", "k", "at")).alias("first"), F.max(F.struct("i", "k", "at")).alias("last"))
    # written, so that the join below is of two plain exchanges: a hot span is split
    first = written(first.where("first <> last").select("h1", "h2", "first"), "repeated")
    later = found.join(first, ["h1", "h2"]).where("struct(i, k, at) <> first").select("i", "k", "at", "n")
    # a document's spans are bounded by its own length
    return later.groupBy("i", "k").agg(F.collect_set(F.struct("at", "n")).alias("covered")).select(F.col("i").alias("__span_id"), F.col("k").alias("__span_key"), F.col("covered").alias("__span_list"))


def without_repeats(docs: DataFrame, **how: int) -> DataFrame:
    """``docs`` with its columns, each text without its repeated spans, and ``n_units_removed``."""
    piece_words = how.get("piece_words", PIECE_WORDS)

    @F.pandas_udf("text string, gone long")
    def remove(texts: pd.Series, covered: pd.Series) -> pd.DataFrame:
        out = []
        for t, c in zip(texts, covered, strict=True):
            if t is None or c is None:
                out.append((None, 0))
            else:
                held = [(x["at"], x["n"]) for x in c]
                out.append((cut(t, held, piece_words), len({u for k, n in held for u in range(k, k + n)})))
        return pd.DataFrame(out, columns=["text", "gone"])

    # else a filter on what it returns is pushed below it and calls it again, with workers of its own
    remove = remove.asNondeterministic()
    marks = written(repeats(docs, **how), "covered")
    own = docs.withColumn("__span_own", text_key(F.col("text")))
    got = own.join(marks, F.col("doc_id").eqNullSafe(F.col("__span_id")) & (F.col("__span_own") == F.col("__span_key")), "left")
    marked = F.col("__span_list").isNotNull()
    got = got.withColumn("__span_cut", remove(F.when(marked, F.col("text")), "__span_list"))
    got = got.withColumn("text", F.when(marked, F.col("__span_cut.text")).otherwise(F.col("text"))).withColumn("n_units_removed", F.coalesce("__span_cut.gone", F.lit(0)).cast("long"))
    return got.drop("__span_own", "__span_id", "__span_key", "__span_list", "__span_cut")
