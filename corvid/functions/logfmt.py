"""Common Log Format parsing as column expressions.

One regular expression judges the whole line, an anchored prefix pattern
gives day and hour, and plain splits cut out the rest, all in the JVM; casts
use ``try_cast`` so ANSI mode turns a malformed number into NULL instead of
failing the job.  Day and hour are read from the text (server-local time),
not from the UTC instant, as the report is about the server's clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# host ident user [dd/Mon/yyyy:HH:mm:ss zone] "request" status bytes
CLF_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[((\d{2})/(\w{3})/(\d{4}):(\d{2}):(\d{2}):(\d{2}) ([^\]]*))\] '
    r'"([^"]*)" (\S+) (\S+)\s*$'
)

# Anchored prefix up to the hour: day and hour need no match of the rest of
# the line (cheaper, and a damaged request does not lose the visit time).
TS_PREFIX = r"^\S+ \S+ \S+ \[(\d{2})/(\w{3})/(\d{4}):(\d{2}):"


def _nullif_empty(c: Column) -> Column:
    return F.when(c == "", F.lit(None)).otherwise(c)


def clf_columns(value: str | Column = "value") -> list[Column]:
    """Parsed columns: host, ts_text, day, hour, request, status, bytes, well_formed.

    The whole-line pattern runs once, as the validity flag; request, status
    and bytes are then cut out with plain string splits (the request is the
    first quoted part, status and bytes the two tokens after it), and are
    NULL on lines the pattern rejects.  Day and hour use the anchored
    prefix pattern, so a damaged request does not lose the visit time.
    """
    v = F.col(value) if isinstance(value, str) else value
    matched = v.rlike(CLF_PATTERN)
    # Leading token without a regex: cheap enough to be repeated when
    # Catalyst pushes a country filter below this projection.
    host = F.substring_index(v, " ", 1)
    quoted = F.split(v, '"', 3)
    tail = F.split(F.trim(F.get(quoted, 2)), " ")
    ts_text = F.substring_index(F.substring_index(v, "]", 1), "[", -1)
    return [
        _nullif_empty(host).alias("host"),
        F.when(matched, ts_text).alias("ts_text"),
        F.regexp_extract(v, TS_PREFIX, 1).try_cast("int").alias("day"),
        F.regexp_extract(v, TS_PREFIX, 4).try_cast("int").alias("hour"),
        F.when(matched, F.get(quoted, 1)).alias("request"),
        F.when(matched, F.get(tail, 0)).try_cast("int").alias("status"),
        F.when(matched, F.get(tail, 1)).try_cast("int").alias("bytes"),
        matched.alias("well_formed"),
    ]


def positional_columns(value: str | Column = "value") -> list[Column]:
    """Whitespace-split parse: fields by position, status/bytes from the end.

    ``get`` returns NULL past the end of the array (plain indexing raises
    under ANSI), and counting status/bytes from the end keeps them right
    when the request has fewer or more than three words.
    """
    v = F.col(value) if isinstance(value, str) else value
    arr = F.split(v, " ")
    n = F.size(arr)
    return [
        F.get(arr, 0).alias("host"),
        F.concat_ws(" ", F.get(arr, 3), F.get(arr, 4)).alias("timestamp"),
        F.get(arr, 5).alias("method"),
        F.get(arr, n - 2).try_cast("int").alias("status"),
        F.get(arr, n - 1).try_cast("int").alias("bytes"),
        n.alias("n_fields"),
    ]


def host_country(host: str | Column = "host") -> Column:
    """Last DNS label of the host ('de' for 'x.uni-bonn.de'); NULL for bare hosts."""
    h = F.col(host) if isinstance(host, str) else host
    # substring_index instead of a regex: same result as '\.([^.]+)$'.
    label = F.substring_index(h, ".", -1)
    return F.when(F.instr(h, ".") > 0, _nullif_empty(label))
