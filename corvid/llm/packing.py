"""Best-fit packing with exact-complement hashing.

Texts become token ids plus an end id.  Documents over the capacity are
cut into full pieces and a rest.  Packing works on the number of pieces of
each length (at most ``capacity`` numbers, at any input size): for the
longest length left, an index by length and by sums of two lengths, kept as
counts fall, and sums of three made of these, gives lengths that fill its
gap exactly, which are used as often as their counts allow; lengths without
an exact complement are filled by best fit (the longest that still fits).  The plan
is a short table of patterns; each pattern serves many sequences, so the
pieces only need their rank within their length to find their place.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; a null doc_id is packed like any other.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import compress
from operator import not_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, giving_back, ranges, slices, written

CAPACITY, END = 4096, 1
#: Parts of words whose ids a worker remembers; beyond that it forgets those it saw in one slice only.
_PARTS_KEPT = 300_000
#: Characters whose different words are looked up together, and of which the ids are gathered together.
_LOOKED_UP, _GATHERED = 1 << 21, 1 << 18
#: Arrow's (and Python's) white space, but not the tokenizer's.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist


#: Letters that the tokenizer's normalization makes a letter and a mark, which joins a sign after it.
_TO_MARKS = "".join(c for c in map(chr, range(0x30000)) if c == "\u0130" or not c.isascii() and c.isalpha() and not unicodedata.normalize("NFC", c).isalpha())


def _of_letters(words: pa.Array) -> pa.Array:
    """Whether a word is letters only, before and after normalization."""
    other = pc.invert(pc.string_is_ascii(words))
    own = words.filter(other)
    return pc.replace_with_mask(pc.utf8_is_alpha(words), other, pc.and_not(pc.utf8_is_alpha(own), pc.match_substring_regex(own, f"[{_TO_MARKS}]")))


class _Words:
    """Token ids of words, by their parts: the tokenizer never joins across white space, nor letters with signs.

    A word of letters, and ASCII signs after it, is two parts: the letters
    (A-Z in lower case), which are tokenized many at a time, and the signs.
    Any other word is one part, tokenized by itself.  Arrow finds the
    different words of a slice and their parts; only these parts, far fewer
    than the words, become Python strings.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # for Latin letters in lower case: nothing to normalize, and words end at spaces
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.part: dict[str, int] = {"": 0}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.n, self.seen = (np.zeros(1 << 15, t) for t in (np.int64, np.int64, np.int32))

    def forget(self) -> None:
        """Keep the parts seen in several slices, half of the room at most."""
        names = list(self.part)  # in the order of their numbers
        seen = self.seen[: len(names)]
        seen[0] = 2  # the empty part stays, as the first
        often = np.argsort(-seen[1:], kind="stable")[: _PARTS_KEPT // 2] + 1
        keep = np.append(0, np.sort(often[seen[often] > 1]))
        n, flat = self.n[keep], self.ids[ranges(self.start[keep], self.n[keep])]
        self.clear()
        self.part = {names[i]: j for j, i in enumerate(keep.tolist())}
        self.ids, self.used = np.concatenate([flat, self.ids]), len(flat)
        self.start, self.n, self.seen = (np.concatenate([x, own]) for x, own in ((np.cumsum(n) - n, self.start), (n, self.n), (seen[keep] // 2, self.seen)))

    def _store(self, parts: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        k, need = len(self.part), self.used + len(flat)
        while need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while k + len(parts) > len(self.n):
            self.start, self.n, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.n, self.seen))
        self.ids[self.used : need] = flat
        self.start[k : k + len(parts)] = self.used + np.cumsum(lens) - lens
        self.n[k : k + len(parts)] = lens
        self.used = need
        self.part.update(zip(parts, range(k, k + len(parts)), strict=True))

    def _singly(self, parts: list[str]) -> None:
        for k in range(0, len(parts), 1000):
            own = parts[k : k + 1000]
            got = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(own, add_special_tokens=False)]
            self._store(own, np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got)))

    def _together(self, parts: list[str], tok, texts: list[str]) -> None:
        """Parts of letters only, and these as ``tok`` is to see them: each is a run of tokens up to one that ends a word."""
        for k in range(0, len(parts), 1000):
            own = parts[k : k + 1000]
            flat = np.array(tok.encode_batch_fast([" ".join(texts[k : k + 1000])], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(own):
                self._store(own, flat, np.diff(last, prepend=-1))
            else:
                self._singly(own)

    def add(self, letters: list[str], odd: list[str]) -> None:
        """Tokenize new parts: those of letters only, and others."""
        latin, other = [], []
        for x in letters:
            (latin if x.isascii() or max(x) < "\u0180" else other).append(x)
        # letters below U+0180 are composed
        self._together(latin, self.plain, [x if x.isascii() else x.lower() for x in latin])
        self._together(other, self.tok, other)
        self._singly(odd)

    def parts(self, words: pa.Array) -> np.ndarray:
        """The numbers of each word's two parts."""
        heads = pc.utf8_rtrim(words, characters=string.punctuation)
        of_letters = _of_letters(heads)
        heads = pc.if_else(of_letters, pc.ascii_lower(heads), words).dictionary_encode()
        signed = np.flatnonzero(pc.and_(of_letters, pc.greater(pc.binary_length(words), pc.binary_length(heads.dictionary.take(heads.indices)))).to_numpy(zero_copy_only=False))
        names = _strings(heads.dictionary)
        at = heads.indices.to_numpy()
        tails = [w[len(names[i]) :] for w, i in zip(_strings(words.take(pa.array(signed))), at[signed].tolist(), strict=True)]

        def new() -> tuple[list[str], list[str]]:
            own = [x for x in names if x not in self.part]
            alpha = _of_letters(pa.array(own, pa.large_string())).to_numpy(zero_copy_only=False).tolist()
            odd = dict.fromkeys([*compress(own, map(not_, alpha)), *(x for x in set(tails) if x not in self.part)])
            return list(compress(own, alpha)), list(odd)

        letters, odd = new()
        if len(self.part) + len(letters) + len(odd) > _PARTS_KEPT:
            self.forget()
            letters, odd = new()
        self.add(letters, odd)
        own = np.fromiter(map(self.part.__getitem__, names), np.int64, len(names))
        self.seen[own] += 1
        out = np.zeros((len(words), 2), np.int64)
        out[:, 0] = own[at]
        out[signed, 1] = np.fromiter(map(self.part.__getitem__, tails), np.int64, len(tails))
        self.seen[out[signed, 1]] += 1
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; each different word of all is looked up once."""
        whole = [any(c in t for c in _NOT_SPACE) for t in texts]
        split = pc.utf8_split_whitespace(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string()))
        coded = split.flatten().dictionary_encode()  # white space at a text's ends gives an empty word, which has no ids
        k = self.parts(coded.dictionary)
        ids, lens = self.ids[ranges(self.start[k].ravel(), self.n[k].ravel())], self.n[k].sum(1)
        starts, words, ends = np.cumsum(lens) - lens, coded.indices.to_numpy(), split.offsets.to_numpy()
        out = []
        for a, b in slices(texts, _GATHERED):
            at = words[ends[a] : ends[b]]
            flat = ids[ranges(starts[at], lens[at])]
            own = np.concatenate([[0], np.cumsum(lens[at])])[ends[a : b + 1] - ends[a]].tolist()
            out += [flat[p:q] for p, q in zip(own[:-1], own[1:], strict=True)]
        for i, t in enumerate(texts):
            if whole[i]:
                out[i] = np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32)
        return out


_words: dict[str, _Words] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32) for every piece of every row."""
    bounded_batches(docs.sparkSession)

    @giving_back
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if tokenizer not in _words:
            _words[tokenizer] = _Words(tokenizer)
        words = _words[tokenizer]
        for pdf in batches:
            out = []
            texts = pdf["t"].tolist()
            encoded = (x for a, b in slices(texts, _LOOKED_UP) for x in words.encode(texts[a:b]))
            for i, k, own in zip(pdf["i"], pdf["k"], encoded, strict=True):
                ids = np.append(own, np.uint32(END)).astype("<u4")
                out += [(i, k, p, s, len(x), zlib.crc32(x.tobytes())) for p, s in enumerate(range(0, len(ids), capacity)) if len(x := ids[s : s + capacity])]
            yield pd.DataFrame(out, columns=["i", "key", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("string").alias("i"), F.coalesce("text", F.lit("")).alias("t")).withColumn("k", F.xxhash64("t"))
    got = rows.mapInPandas(cut, "i string, key long, piece int, start long, length long, ids_crc32 long")
    return got.select(F.col("i").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "key", "piece", "start", "length", "ids_crc32")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, longest first, and how often each is used."""
    index = _Sums(counts, capacity)
    have, out = index.have, []

    def use(pattern: tuple[int, ...]) -> None:
        own, n = np.unique(pattern, return_counts=True)
        times = int((have[own] // n).min())
        for x, k in zip(own.tolist(), n.tolist(), strict=True):
            index.add(x, -k * times)
        out.append((pattern, times))

    if have[capacity]:
        use((capacity,))
    for longest in range(capacity - 1, 0, -1):
        while have[longest] > 0:
            index.add(longest, -1)
            found = index.exact(capacity - longest)
            index.add(longest, 1)
            if not found:
                break  # no exact complement: by best fit below
            use((longest, *found))
    for longest in range(capacity - 1, 0, -1):
        while have[longest] > 0:
            index.add(longest, -1)
            pattern, gap = [longest], capacity - longest
            while gap and (fit := np.flatnonzero(have[1 : gap + 1])).size:
                pattern.append(int(fit[-1]) + 1)
                index.add(pattern[-1], -1)
                gap -= pattern[-1]
            for x in pattern:
                index.add(x, 1)
            use(tuple(pattern))
    return out


class _Sums:
    """Lengths by how many are left, and the sums that one or two of them make.

    ``pairs[s]`` is the number of different pairs of lengths left that sum to
    ``s``.  It is kept up to date: only a length that runs out, or comes back,
    or is left once, changes the pairs it is in.  Sums of three are a length
    and a pair sum.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.have, self.pairs = np.zeros(capacity + 1, np.int64), np.zeros(2 * capacity + 1, np.int64)
        for k, n in counts.items():
            self.add(k, n)

    def add(self, length: int, n: int) -> None:
        before, after = int(self.have[length]), int(self.have[length]) + n
        self.have[length] = after
        if (before > 0) != (after > 0):
            other = np.flatnonzero(self.have)
            other = other[other != length]
            self.pairs[other + length] += 1 if after > 0 else -1
        self.pairs[2 * length] += (after > 1) - (before > 1)

    def pair(self, gap: int) -> tuple[int, int] | None:
        """Two lengths left that sum to ``gap``, the first as long as can be."""
        if not self.pairs[gap]:
            return None
        low = np.arange(1, gap // 2 + 1)
        ok = (self.have[low] > 0) & (self.have[gap - low] > 0)
        if gap % 2 == 0:
            ok[-1] = self.have[gap // 2] > 1
        first = int(low[ok.argmax()])
        return gap - first, first

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths left that sum to ``gap``; the longest first of three."""
        if self.have[gap] > 0:
            return (gap,)
        if two := self.pair(gap):
            return two
        own = np.arange(1, gap)
        for a in own[(self.have[own] > 0) & (self.pairs[gap - own] > 0)][::-1].tolist():
            self.add(a, -1)
            two = self.pair(gap - a)
            self.add(a, 1)
            if two:
                return (a, *two)
        return None


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), in order: the ranks of a length go to the patterns in turn."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, rank.get(length, 0), sequence, offset))
            rank[length] = rank.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece."""
    # the salt deals rows that are equal in all to several parts of their length
    cut = written(pieces(docs, tokenizer, capacity).withColumn("salt", F.floor(F.rand(5) * (1 << 20))), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    table = _places(plan(counts, capacity))
    starts = table[:, 0] << 40 | table[:, 1]
    # A hot length is ranked in parts: rank = rows of earlier parts + rank in the part.
    parts = max(16, max(counts.values(), default=0) // 50_000)
    salted = cut.withColumn("part", F.pmod("salt", F.lit(parts)))
    before = F.expr("coalesce(sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding), 0)")
    offsets = salted.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", before.alias("before"))
    ranked = salted.withColumn("r", F.expr("row_number() over (partition by length, part order by doc_id, key, piece)")).join(offsets, ["length", "part"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        k = np.searchsorted(starts, length << 40 | rank, side="right") - 1
        return pd.DataFrame({"sequence_id": table[k, 2] + rank - table[k, 1], "offset": table[k, 3]})

    placed = ranked.withColumn("p", place("length", F.col("r") - 1 + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset")
