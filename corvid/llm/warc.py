"""WARC archives with an index first.

``write`` lets every task write one archive, each record a gzip member of
its own, into the shared scratch folder under a name that no other attempt
uses, and returns the index: file, offset, length, URL, digest of each
record.  The index is a table; only records it names count, so files of
lost attempts are never read.  ``read`` takes any selection of index rows,
sorts them by file and offset, joins neighbouring byte ranges into reads
of bounded size, and checks each payload's digest.

Of records with equal payloads of at least ``least_bytes``, that of the
largest page_id is a ``response``; the others are ``revisit`` records,
which keep the HTTP head (with the length of the full payload) and name
the response.

Defined cases: a null html is an empty payload; a null url is written as
an empty target; rows that share the largest page_id of their payload are
all responses; a null page_id is smaller than any other, and with no other
in its group its rows are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, scratch_dir, written
from corvid.sources.files import arrow_filesystem, qualified

INDEX = "file string, offset long, size long, page_id long, url string, payload_digest string, record_type string, refers_to long"
#: Ranges with a smaller gap become one read, up to so many bytes.
GAP, READ = 64 << 10, 4 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, name: str, when: str) -> tuple[bytes, str]:
    """A response, or a revisit if refers_to is given, and the payload's digest."""
    sha = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {name}')}>",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[4:4] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", sha


def parse(raw: bytes) -> dict:
    """Page, type, digest, full payload length and payload (None for a revisit) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    own, other = fields["X-Page-ID"].strip(), fields.get("X-Refers-To-Page-ID", "")
    out = {"page_id": int(own) if own else None, "url": fields["WARC-Target-URI"], "payload_bytes": length, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"], "refers_to": int(other) if other else None}
    return out | {"payload": payload if out["record_type"] == "response" else None}


def assign_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to (null for a response) for every row.

    Digests are grouped without the pages: only narrow rows meet on a hot
    payload, and the pages themselves join on page_id.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"), F.sha1(payload).alias("sha"))
    narrow = rows.where(F.octet_length("html") >= least_bytes).select("page_id", "sha")
    groups = written(narrow.groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n"), "payloads")
    revisits = narrow.join(groups, "sha").where("not (page_id <=> last)").distinct().withColumnRenamed("last", "refers_to")
    revisits = revisits.select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "refers_to")
    return rows.join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left").select("page_id", "url", "html", "refers_to")


def write(pages: DataFrame, least_bytes: int = 0, when: str = "2024-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Archives of all pages; their index, written."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = qualified(spark, scratch_dir(spark, "warc"))

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, at, own = None, 0, ""
        try:
            for pdf in batches:
                if out is None:
                    own = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    files, path = arrow_filesystem(own)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                rows = []
                for i, u, h, r in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["refers_to"], strict=True):
                    i, r = (None if pd.isna(x) else int(x) for x in (i, r))
                    raw, sha = record(i, u, h.encode("utf-8", "surrogatepass"), r, f"{u} {at}", when)
                    z = zlib.compressobj(level, wbits=31)
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    rows.append((own, at, len(member), i, u, sha, "response" if r is None else "revisit", r))
                    at += len(member)
                frame = pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    pages = assign_types(pages, least_bytes).select("page_id", "url", "html", "refers_to")
    return written(pages.mapInPandas(archive, INDEX), "warc-index")


def read(index: DataFrame, payloads: bool = False) -> DataFrame:
    """The records that ``index`` names, by coalesced byte ranges."""
    spark = index.sparkSession
    bounded_batches(spark)
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for own, rows in pdf.sort_values(["file", "offset"]).groupby("file", sort=False):
                spans: list[list[int]] = []
                for start, size in zip(rows["offset"].tolist(), rows["size"].tolist(), strict=True):
                    if spans and start - spans[-1][1] <= GAP and start + size - spans[-1][0] <= READ:
                        spans[-1][1] = max(spans[-1][1], start + size)
                        spans[-1][2].append((start, size))
                    else:
                        spans.append([start, start + size, [(start, size)]])
                files, path = arrow_filesystem(own)
                with files.open_input_file(path) as f:
                    for start, end, held in spans:
                        f.seek(start)
                        raw, out = f.read(end - start), []
                        for at, size in held:
                            got = parse(zlib.decompress(raw[at - start : at - start + size], wbits=31))
                            if got["payload"] is not None and (digest(got["payload"]) != got["payload_digest"] or len(got["payload"]) != got["payload_bytes"]):
                                raise OSError(f"{own} at {at}: the payload is not what its record says")
                            out.append(got)
                        yield pd.DataFrame(out)[columns].astype({"page_id": "Int64", "refers_to": "Int64"})

    # a task gets whole stretches of an archive, in order; their number follows from the bytes to read
    stretch = F.floor(F.col("offset") / READ)
    size = index.agg(F.sum("size").alias("b")).collect()[0].b or 0
    rows = index.select("file", "offset", "size").repartition(max(1, math.ceil(size / (2 * READ))), "file", stretch).sortWithinPartitions("file", "offset")
    return rows.mapInPandas(fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages``, read the archives back: a row for each page."""
    return read(write(pages, least_bytes)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
