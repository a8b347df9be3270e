"""Parallel reads of large gzip logs by an index of access points.

A gzip file is one stream: Spark reads it in one task.  ``build`` inflates
each file once and notes an access point about every ``span`` bytes of text,
at the start of a deflate block: the bit offset in the file, the place in the
text, and the 32 KB of text before it, which the block may refer to.  The
index is a Parquet table, written once.  ``read_lines`` then starts a task at
each access point: it sets the window, reads the file from there, and returns
the lines that begin before the next point, so every line comes out once.

zlib can start a stream from a window at a byte, but blocks start at bits.
The reader therefore puts empty blocks in front, of as many bits as it takes
for the rest to fall into place: one with fixed codes has 10 bits, one with
its own codes 91.

Block starts are found with zlib's C interface (``inflate`` with ``Z_BLOCK``),
as Python's has none.  Files with several gzip members are indexed through
all of them.  Text is UTF-8, lines end in a line feed, with or without a
carriage return before it.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.sources.files import arrow_filesystem, qualified

SPAN, READ, WINDOW = 8 << 20, 1 << 20, 1 << 15
INDEX = "file string, point long, bit_offset long, text_offset long, text_end long, window binary"
# fixed values of zlib's interface
_Z_BLOCK, _GZIP, _OK, _END, _BUF = 5, 15 + 16, 0, 1, -5


class _Stream(ctypes.Structure):
    """zlib's z_stream."""

    _fields_ = [
        ("next_in", ctypes.c_void_p), ("avail_in", ctypes.c_uint), ("total_in", ctypes.c_ulong),
        ("next_out", ctypes.c_void_p), ("avail_out", ctypes.c_uint), ("total_out", ctypes.c_ulong),
        ("msg", ctypes.c_char_p), ("state", ctypes.c_void_p), ("zalloc", ctypes.c_void_p), ("zfree", ctypes.c_void_p), ("opaque", ctypes.c_void_p),
        ("data_type", ctypes.c_int), ("adler", ctypes.c_ulong), ("reserved", ctypes.c_ulong),
    ]


def _zlib() -> ctypes.CDLL:
    for name in ("libz.so.1", "libz.dylib", "libz.so", "zlib1.dll"):
        try:
            lib = ctypes.CDLL(name)
        except OSError:
            continue
        lib.zlibVersion.restype = ctypes.c_char_p
        return lib
    raise RuntimeError("zlib's shared library is not on this machine")


def access_points(blocks: Iterator[bytes], span: int = SPAN) -> Iterator[tuple[int, int, bytes, bool]]:
    """(bit offset, text offset, window, ends a member) of a gzip file's access points, and its end.

    A member's first point is at its header (whole bytes, empty window); the
    last row is the end of the text.
    """
    lib, stream = _zlib(), _Stream()
    if lib.inflateInit2_(ctypes.byref(stream), _GZIP, lib.zlibVersion(), ctypes.sizeof(stream)) != _OK:
        raise RuntimeError("zlib could not start")
    out = ctypes.create_string_buffer(1 << 18)
    read, text, last, window, begun = 0, 0, 0, b"", False
    try:
        for block in blocks:
            source = ctypes.create_string_buffer(block, len(block))
            stream.next_in, stream.avail_in = ctypes.addressof(source), len(block)
            while True:
                if not begun:
                    if not stream.avail_in:
                        break
                    yield (read + len(block) - stream.avail_in) * 8, text, b"", True
                    begun, last, window = True, text, b""
                stream.next_out, stream.avail_out = ctypes.addressof(out), len(out)
                got = lib.inflate(ctypes.byref(stream), _Z_BLOCK)
                if got not in (_OK, _END, _BUF):
                    raise ValueError(f"damaged gzip data near byte {read + len(block) - stream.avail_in}: {(stream.msg or b'').decode()}")
                made = len(out) - stream.avail_out
                text += made
                window = (window + out.raw[:made])[-WINDOW:] if made else window
                if got == _END:
                    lib.inflateReset2(ctypes.byref(stream), _GZIP)
                    begun = False
                elif stream.data_type & 128 and not stream.data_type & 64 and text - last >= span:
                    # at the end of a block that is not the last
                    yield (read + len(block) - stream.avail_in) * 8 - (stream.data_type & 7), text, window, False
                    last = text
                if got == _BUF or (not stream.avail_in and stream.avail_out):
                    break
            read += len(block)
        yield read * 8, text, b"", True
    finally:
        lib.inflateEnd(ctypes.byref(stream))


def _bits(*parts: tuple[int, int]) -> tuple[int, int]:
    """(value, number of bits) of (value, bits) parts, the first in the lowest bits."""
    value = at = 0
    for v, n in parts:
        value |= v << at
        at += n
    return value, at


def _empty_fixed() -> tuple[int, int]:
    """A block of fixed codes that holds its end only: header 0, 01, then the end's code of seven zeros."""
    return _bits((0, 1), (1, 2), (0, 7))


def _empty_own() -> tuple[int, int]:
    """A block with its own codes that holds its end only, of an odd number of bits.

    Lengths are coded with two symbols, 1 (a length of one, code 0) and 18
    (11 to 138 zeros, code 1): literal 0 and the end get codes of one bit, and
    so does the one distance.
    """
    order = [16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1]  # fixed value: deflate's order of code lengths
    lengths = [(1 if s in (1, 18) else 0, 3) for s in order]
    one, zeros = (0, 1), lambda n: [(1, 1), (n - 11, 7)]
    return _bits((0, 1), (2, 2), (0, 5), (0, 5), (len(order) - 4, 4), *lengths, one, *zeros(138), *zeros(117), one, one, (1, 1))


def _prefix(bits: int) -> tuple[int, int]:
    """Empty blocks whose bits end ``bits`` (0 to 7) into a byte."""
    parts = [_empty_own()] if bits % 2 else []
    while sum(n for _, n in parts) % 8 != bits:
        parts.append(_empty_fixed())
    return _bits(*parts)


def inflated(handle, bit_offset: int, window: bytes, member: bool, read: int = READ) -> Iterator[bytes]:
    """The text of a file from an access point on, through all members that follow."""
    handle.seek(bit_offset // 8)
    if member:
        d, first = zlib.decompressobj(_GZIP), b""
    else:
        d = zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15)
        value, n = _prefix(bit_offset % 8)
        lead = handle.read(1) if bit_offset % 8 else b""
        whole, rest = divmod(n, 8)
        if lead:
            value |= (lead[0] >> rest << rest) << (8 * whole)
            whole += 1
        first = value.to_bytes(whole, "little")
    raw, skip = not member, 0
    while data := first or handle.read(read):
        first = b""
        while data:
            if skip:
                skip, data = max(0, skip - len(data)), data[skip:]
                continue
            yield d.decompress(data)
            data = b""
            if d.eof:
                # a raw stream leaves its member's check sums to us
                data, skip = d.unused_data, 8 if raw else 0
                d, raw = zlib.decompressobj(_GZIP), False


def build(spark: SparkSession, paths: list[str], index_path: str, span: int = SPAN) -> DataFrame:
    """Write the index of gzip files (a task a file), and return it."""
    files = spark.createDataFrame([(qualified(spark, p),) for p in paths], "file string").repartition(max(1, len(paths)), "file")

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file in pdf["file"]:
                system, path = arrow_filesystem(file)
                with system.open_input_stream(path, compression=None) as f:
                    held = None
                    for k, (bit, text, window, member) in enumerate(access_points(iter(lambda: f.read(READ), b""), span)):
                        if held is not None:
                            yield pd.DataFrame([(file, held[0], held[1], held[2], text, held[3])], columns=["file", "point", "bit_offset", "text_offset", "text_end", "window"])
                        held = (k, bit, text, None if member else window)

    files.mapInPandas(points, INDEX).write.mode("overwrite").parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)


def read_lines(index: DataFrame, partitions: int | None = None) -> DataFrame:
    """(value) for every line of the indexed files, a range of text at a time.

    A range holds the lines that begin in it: it drops what comes before its
    first line feed (unless it is at the file's start) and reads on to the end
    of its last line.
    """
    spark = index.sparkSession

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                system, path = arrow_filesystem(row.file)
                with system.open_input_file(path) as f:
                    member = row.window is None
                    for some in _range_lines(inflated(f, row.bit_offset, row.window or b"", member), row.text_offset, row.text_end):
                        yield pd.DataFrame({"value": some})

    points = index.where("text_end > text_offset")
    dealt = points.repartition(partitions or spark.sparkContext.defaultParallelism, "file", "point")
    return dealt.mapInPandas(lines, "value string")


def _range_lines(text: Iterator[bytes], start: int, end: int) -> Iterator[list[str]]:
    """Lists of the lines that begin in [start, end); a line begins after a line feed or at 0."""
    # the byte before ``start`` is unknown: unless at 0, a line begins after the first feed at start - 1 or later,
    # so the line that begins at ``start`` itself belongs to the range before, which reads on one line past its end
    at, held, open_ = start, b"", start == 0
    for some in text:
        held += some
        if not open_:
            cut = held.find(b"\n")
            if cut < 0:
                at += len(held)
                held = b""
                if at > end:
                    return
                continue
            at, held, open_ = at + cut + 1, held[cut + 1 :], True
        if at > end:
            return
        own = []
        begin = 0
        while (cut := held.find(b"\n", begin)) >= 0 and at <= end:
            own.append(held[begin:cut])
            at += cut + 1 - begin
            begin = cut + 1
        held = held[begin:]
        if own:
            yield [x.removesuffix(b"\r").decode("utf-8", "replace") for x in own]
        if at > end:
            return
    if open_ and held and at <= end:
        yield [held.removesuffix(b"\r").decode("utf-8", "replace")]
