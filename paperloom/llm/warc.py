"""WARC archives: writing with revisit records, and reading them in splits.

A reader that starts in the middle of a file cannot tell a record's first line from the same
bytes inside a payload. So every task lists all candidates of its split with the offset at which
each one's record would end, follows them as far as the split goes, and reports where they leave
it. Which of these ways starts at the file's beginning is found by pointer doubling over the
crossings of splits (a few rows for each split); only then records are read, each split from its
one true entry.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, stage
from paperloom.llm.common import column, ship, written

SPLIT_BYTES = 16 * 1024 * 1024
FILE_RECORDS = 50_000
MIN_REVISIT_BYTES = 1000
# The format's own marks.
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
HEADER_END = b"\r\n\r\n"
RECORD_END = b"\r\n\r\n"

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def write_archive(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row of `pages` (page_id, url, html), in WARC files below `path`.

    The payload is the html in UTF-8, a null one empty. Of rows with equal payloads of at least
    `min_revisit_bytes`, those with the largest page_id are responses, the others revisits
    without a payload that refer to it; all smaller payloads are responses. A row without
    page_id is a response, and none is referred to. Other columns are not looked at.
    """
    payload = F.coalesce(column("html"), F.lit(""))
    rows = pages.select(
        column("page_id").cast("long").alias("page_id"),
        column("url").alias("url"),
        payload.alias("payload"),
        F.sha1(F.encode(payload, "UTF-8")).alias("digest"),
        F.octet_length(payload).alias("bytes"),
    )
    shared = stage(
        rows.filter(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        "warc-copies",
    )
    firsts = F.broadcast(shared.frame) if shared.fits(BROADCAST_BYTES) else shared.frame
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(HEADER_END.decode()))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))

    def line(name: str, value) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    def urn(page) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    uri = F.regexp_replace("url", r"[\r\n]+", " ")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("first")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    records = rows.join(firsts, "digest", "left").select(F.concat(header, block).alias("value"))
    (
        records.write.option("lineSep", RECORD_END.decode())
        .option("compression", "none")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


class _File:
    """Reads byte ranges of a file in any file system that Arrow knows."""

    def __init__(self, name: str):
        from pyarrow import fs

        parts = urlsplit(name)
        if parts.scheme in ("", "file"):
            system, path = fs.LocalFileSystem(), re.sub("^file:/*", "/", name)
        else:
            scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
            rest = name.split("://", 1)[1]
            system, path = fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@=+,')}")
        self.source = system.open_input_file(path)
        self.size = self.source.size()

    def read(self, start: int, size: int) -> bytes:
        return self.source.read_at(max(0, min(size, self.size - start)), start)

    def header(self, start: int, window: int = 8192) -> tuple[dict[str, str], int] | None:
        """Fields of the header at `start` and the offset of what follows it."""
        while True:
            head = self.read(start, window)
            if not MAGIC.match(head):
                return None
            end = head.find(HEADER_END)
            if end >= 0:
                break
            if start + window >= self.size:
                return None
            window *= 8
        fields = {}
        for entry in head[:end].split(b"\r\n")[1:]:
            name, mark, value = entry.partition(b":")
            if mark:
                fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        return fields, start + end + len(HEADER_END)

    def record(self, start: int) -> tuple[dict[str, str], int, int] | None:
        """Header fields, beginning and length of the block of a whole record that starts here."""
        found = self.header(start)
        length = found[0].get("content-length", "") if found else ""
        if not (length.isascii() and length.isdigit()):
            return None
        whole = found[1] + int(length) + len(RECORD_END) <= self.size
        return (*found, int(length)) if whole else None

    def successor(self, start: int) -> int | None:
        """Where a record that starts here would end, if there is a whole one."""
        found = self.record(start)
        return found and found[1] + found[2] + len(RECORD_END)


def _crossings(batches):
    """For each candidate of each split: the first offset beyond the split on its way.

    A way that breaks off inside the split leads to no other; its records are read all the same
    if its beginning is reached.
    """
    for batch in batches:
        rows = []
        for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            file = _File(name)
            text = file.read(start, end - start + 16)
            at = [start + m.start() for m in MAGIC.finditer(text)]
            leaves: dict[int, int | None] = {}
            for offset in reversed([a for a in at if a < end]):
                following = file.successor(offset)
                if following is not None and following < end:
                    following = leaves.get(following)
                leaves[offset] = following
            rows.extend((name, a, b) for a, b in leaves.items() if b is not None)
        names, offsets, exits = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(exits, pa.int64())],
            ["file", "offset", "exit"],
        )


def _reachable(crossings: DataFrame, files: DataFrame) -> DataFrame:
    """Entries of splits that lie on the way from a file's beginning: file, offset."""
    beginnings = files.select("file", F.lit(0).cast("long").alias("offset"))
    # Only where some way leads to, or a file begins, can an entry be.
    targets = crossings.select("file", F.col("exit").alias("offset")).distinct()
    jumps = written(
        crossings.join(targets, ["file", "offset"], "left_semi")
        .unionByName(crossings.filter("offset = 0"))
        .distinct(),
        "warc-jumps",
    )
    reached = written(beginnings, "warc-reached")
    while True:
        ahead = jumps.join(reached, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        more = written(reached.unionByName(ahead).distinct(), "warc-reached")
        if more.count() == reached.count():
            return more
        reached = more
        following = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("next"))
        jumps = written(
            jumps.join(following, ["file", "exit"]).select("file", "offset", F.col("next").alias("exit")),
            "warc-jumps",
        )


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _records(with_payload: bool):
    """Read the records of a split from its entry on."""
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "broken_at"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64()]

    def run(batches):
        for batch in batches:
            for name, at, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file, rows, size = _File(name), [], 0
                while at < end and at < file.size:
                    found, here = file.record(at), at
                    if found is None:
                        rows.append((None, "broken", None, None, None, None, here))
                        break
                    fields, body, length = found
                    block = file.read(body, length)
                    at = body + length + len(RECORD_END)
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block[block.find(HEADER_END) + len(HEADER_END) :]
                    digest = hashlib.sha1(payload).hexdigest()
                    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    if kind == "response" and said and said != digest:
                        rows.append((None, "broken", None, None, None, None, here))
                        continue  # lost bytes show there, as no record begins at its end
                    page = _page(fields.get("warc-record-id"))
                    if kind == "revisit":
                        first = _page(fields.get("warc-refers-to"))
                        rows.append((page, kind, first, None, said or None, None, None))
                    else:
                        kept = payload if with_payload else None
                        rows.append((page, kind, None, len(payload), digest, kept, None))
                    size += len(payload)
                    if size > SPLIT_BYTES:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    return run


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


def read_archive(
    spark: SparkSession, path: str, with_payload: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Response and revisit records of all files below `path`.

    Returns page_id, record_type, refers_to, payload_bytes, payload_digest (hex SHA-1), payload
    (null unless asked for) and broken_at. Of a revisit the digest is what its header says, bytes
    and payload are null. Bytes inside a payload that look like a record are not one. Headers may
    have any length. All whole records in front of a broken or cut one are returned, and for that
    one a row of type "broken" with its offset in the file as broken_at, else null; a payload that
    contradicts its digest makes a record broken. What follows it is returned only if it begins
    where the broken one says that it ends; else that place is broken too. A file that does not begin with a record is broken
    at 0. No files and empty files give an empty result.
    """
    ship(spark)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .filter("length > 0")
        .select("path", "length")
    )
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes)))
    splits = written(
        files.select(F.col("path").alias("file"), "length", starts.alias("start")).select(
            "file", "start", F.least(F.col("start") + split_bytes, "length").alias("end")
        ),
        "warc-splits",
    )
    n = max(1, splits.count())
    crossings = written(
        splits.repartition(n).mapInArrow(_crossings, "file string, offset long, exit long"),
        "warc-crossings",
    )
    entries = _reachable(crossings, files.select(F.col("path").alias("file")))
    split_start = F.floor(F.col("offset") / split_bytes) * split_bytes
    # A split has one entry on the true way; one that a record spans has none.
    work = (
        entries.withColumn("start", split_start.cast("long"))
        .join(splits, ["file", "start"])
        .groupBy("file", "start", "end")
        .agg(F.min("offset").alias("offset"))
        .select("file", "offset", "end")
    )
    return work.repartition(n).mapInArrow(
        _records(with_payload),
        "page_id long, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary, broken_at long",
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits get size and digest of the response that they refer to.

    That is the one with the page_id and, where the revisit names it, the digest: page ids may
    repeat. Only revisits are joined, all other rows stay as they are.
    """
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    asked = records.filter(revisit)
    found = stage(
        records.filter("record_type = 'response'")
        .join(asked.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("full_digest"))
        .agg(F.max("payload_bytes").alias("full_bytes")),
        "warc-responses",
    )
    hinted = lambda df: F.broadcast(df) if found.fits(BROADCAST_BYTES) else df
    full = found.frame.withColumn("payload_digest", F.col("full_digest"))
    one = found.frame.groupBy("refers_to").agg(
        F.min_by("full_bytes", "full_digest").alias("full_bytes"), F.min("full_digest").alias("full_digest")
    )
    named = asked.filter("payload_digest IS NOT NULL").join(hinted(full), ["refers_to", "payload_digest"], "left")
    nameless = asked.filter("payload_digest IS NULL").join(hinted(one), "refers_to", "left")
    resolved = named.unionByName(nameless).withColumns(
        {
            "payload_bytes": F.coalesce("payload_bytes", "full_bytes"),
            "payload_digest": F.coalesce("full_digest", "payload_digest"),
        }
    )
    return records.filter(~revisit).unionByName(resolved.drop("full_bytes", "full_digest"))
