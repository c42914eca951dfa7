"""WARC archives: writing records with segments and reading them back whole.

A payload longer than the segment size goes out as a first record and continuation
records that name it as their origin.  Reading groups continuation records by origin
identifier, orders them by segment number, verifies the total length and the digest,
and decodes chunked transfer framing.

Archives are gzip files of records as Spark's text writer makes them: a record ends
with two line ends, which is the writer's line separator.  They are read as streams
of pieces between version lines; a piece is put together with the next ones until
the record has its stated length, so a version line inside a payload does no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgrain.llm.common import map_batches, stored

VERSION = "WARC/1.1\r\n"
_CHUNK = 2048
_DATE = "2024-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = _CHUNK) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload in chunked framing; None if the framing is broken or cut off."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def response_block(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response; None if it is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    framed = any(
        line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")[1:]
    )
    return unchunked(body) if framed else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return (VERSION + lines + "\r\n").encode() + block


def _one_line(value: str | None) -> str:
    return " ".join((value or "").split())


def page_records(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int,
    row: int | None = None,
) -> list[bytes]:
    """The records of a page: a revisit, a response, or a response in segments.

    They are named by page_id and digest, and by ``row`` where these don't tell rows apart.
    """
    name = f"urn:page:{'null' if page_id is None else page_id}/{digest}" + ("" if row is None else f"/{row}")
    key, base = f"<{name}>", [("WARC-Date", _DATE), ("WARC-Target-URI", _one_line(url))]
    base += [("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", key), *base, ("WARC-Refers-To", f"<urn:page:{refers_to}/{digest}>"),
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("Content-Type", "application/http; msgtype=response")]
        return [record(fields, block)]
    block = response_block(payload)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", key), *base, ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment:
        return [record(first, block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [record([*first, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{number}>"), ("WARC-Date", _DATE),
                  ("WARC-Segment-Origin-ID", key), ("WARC-Segment-Number", number)]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(record(fields, part))
    return out


def revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Rows (page_id, url, payload, digest, refers_to, row): pages and the response that each revisits, if any.

    Of pages with equal payloads of at least ``least`` bytes, that with the largest
    page_id is the response.  Payloads are grouped by digest and length only.  ``row``
    is null but for rows without page_id and all but one of those with equal page_id
    and payload; no two have the same.  Runs jobs.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    kept = (
        rows.where(F.col("bytes") >= least).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    key = ["page_id", "digest", "bytes"]
    copies = stored(rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1 and page_id is not null").drop("n"))
    if copies.isEmpty():
        rows = rows.withColumn("copy", F.lit(None).cast("long"))
    else:
        # only repeated rows are written once more: their numbers must stay as they are
        again = stored(rows.join(copies, key, "left_semi").withColumn("own", F.monotonically_increasing_id()))
        first = stored(again.groupBy(*key).agg(F.min("own").alias("own")).select("own", F.lit(True).alias("first")))
        again = again.join(first, "own", "left").withColumn("copy", F.when(F.col("first").isNull(), F.col("own")))
        once = rows.join(copies, key, "left_anti").withColumn("copy", F.lit(None).cast("long"))
        rows = once.unionByName(again.select(*once.columns))
    # written, so that its size is known: while it is small no payload is shuffled
    return rows.join(stored(kept), ["digest", "bytes"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id") != F.col("kept"), F.col("kept")).alias("refers_to"),
        F.when(F.col("page_id").isNull(), F.monotonically_increasing_id()).otherwise(F.col("copy")).alias("row"),
    )


def write_archives(
    pages: DataFrame, path: str, segment: int = 4096, least: int = 1000, unnamed: bool = False
) -> None:
    """Write the pages (page_id, url, html) as gzip archives below ``path``.  Runs jobs.

    Null html is an empty payload, a null url an empty field.  Each row has records of
    its own, also where page_id is repeated.  Rows without page_id get generated
    identifiers if ``unnamed`` is set and raise an error otherwise.
    """

    def of(batch):
        out = []
        for row in batch.to_pylist():
            if row["page_id"] is None and not unnamed:
                raise ValueError("a page without page_id can't be archived")
            out += page_records(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], segment, row["row"])
        return {"record": out}

    records = map_batches(revisits(pages, least), of, "record binary")
    # the text writer passes bytes through as they are
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).text(path)


def _head(piece: bytes) -> tuple[dict[str, str], bytes] | None:
    head, gap, block = piece.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields, block


def _whole_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """(fields, block, whether it has its stated length) of the records in a stream of pieces."""
    fields, block, length = None, b"", 0
    for piece in pieces:
        if fields is not None:
            block += VERSION.encode() + piece
        else:
            started = _head(piece)
            if started is None:
                continue  # what stands before the first record
            fields, block = started
            length = int(fields.get("content-length", 0))
        if len(block) >= length:
            yield fields, block[:length], True
            fields = None
    if fields is not None:
        yield fields, block, False


_FIELDS = ("type", "id", "origin", "digest", "refers_to", "number", "total", "block", "whole")
_RECORD = "type string, id string, origin string, digest string, refers_to string, number int, total long, block binary, whole boolean"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the gzip archives below ``path``, continuation records included.

    gzip files are not split, so a task reads its files' pieces in order and holds one
    record at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_RECORD))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def flush():
            columns = [pa.array([r[i] for r in out], type=f.type) for i, f in enumerate(schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for f, block, whole in _whole_records(p for b in batches for p in b.column(0).to_pylist()):
            number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
            out.append((
                f.get("warc-type"), f.get("warc-record-id"), f.get("warc-segment-origin-id"),
                f.get("warc-payload-digest", "").removeprefix("sha1:") or None, f.get("warc-refers-to"),
                int(number) if number else None, int(total) if total else None, block, whole,
            ))
            size += len(block)
            if len(out) >= 256 or size > 1 << 24:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    lines = spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(of, _RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Rows (id, type, digest, refers_to, block, complete): records with their continuations joined on.

    Only records with a segment number are grouped.  The segments of one origin, a
    single row, are put in order of their numbers; ``complete`` says that they run
    from 1 without gap or repeat, that each has its own length and that together they
    have the stated total.  Continuations without a
    first record give a row of type null that is not complete.
    """
    segmented = F.coalesce(F.col("type") == "continuation", F.lit(False)) | F.col("number").isNotNull()
    singles = records.where(~segmented).select("id", "type", "digest", "refers_to", "block", F.col("whole").alias("complete"))
    part = F.struct("number", "block", "total", "whole", "type", "digest", "refers_to")
    grouped = (
        records.where(segmented).groupBy(F.coalesce("origin", "id").alias("key"))
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
    )
    first = F.col("parts")[0]
    numbers = F.col("parts.number")
    block = F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.block))")
    total = F.array_max("parts.total")
    joined = grouped.select(
        F.col("key").alias("id"), first["type"].alias("type"), first["digest"].alias("digest"),
        first["refers_to"].alias("refers_to"), block.alias("block"), total.alias("total"),
        (
            (numbers == F.sequence(F.lit(1), F.size("parts"))) & F.forall("parts.whole", lambda w: w)
            & (first["type"] != "continuation")
        ).alias("ordered"),
    ).select(
        "id", F.when(F.col("type") != "continuation", F.col("type")).alias("type"), "digest", "refers_to", "block",
        F.coalesce(F.col("ordered") & (F.octet_length("block") == F.col("total")), F.lit(False)).alias("complete"),
    )
    return singles.unionByName(joined)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, payload, payload_bytes, payload_digest, record_type, refers_to, intact) of the archives.

    A revisit has its response's payload digest and length, no payload.  ``intact``
    says that the record is complete, its framing sound and its digest right.
    """

    def of(batch):
        out = {k: [] for k in ("id", "type", "refers_to", "payload", "digest", "intact")}
        for row in batch.to_pylist():
            payload = payload_of(row["block"]) if row["type"] == "response" else None
            found = hashlib.sha1(payload).hexdigest() if payload is not None else row["digest"]
            out["id"].append(row["id"])
            out["type"].append(row["type"])
            out["refers_to"].append(row["refers_to"])
            out["payload"].append(payload)
            out["digest"].append(found)
            out["intact"].append(bool(
                row["complete"] and row["type"] and found == row["digest"]
                and (payload is not None or row["type"] == "revisit")
            ))
        return out

    schema = "id string, type string, refers_to string, payload binary, digest string, intact boolean"
    found = map_batches(reassemble(read_records(spark, path)), of, schema)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)(?:/[^>]*)?>$", 1).try_cast("long")
    return found.select(
        number(F.col("id")).alias("page_id"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        number(F.col("refers_to")).alias("refers_to"), "intact",
    )


def round_trip(pages: DataFrame, path: str, segment: int = 4096, least: int = 1000) -> DataFrame:
    """Write the archives below ``path``, read them back and give a row for each page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, intact); a revisit
    has the length of the response it refers to.  Repeated rows and rows without
    page_id have a row each.  Runs jobs.
    """
    write_archives(pages, path, segment, least, unnamed=True)
    spark = pages.sparkSession
    read = stored(read_pages(spark, path).drop("payload"))
    # a page_id may have several responses: that of the revisit's digest counts, once
    responses = (
        read.where("record_type = 'response' and page_id is not null")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
    )
    again = read.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
        (F.col("intact") & F.col("full_bytes").isNotNull()).alias("intact"),
    )
    rest = read.where("record_type is null or record_type != 'revisit'")
    return rest.select(*again.columns).unionByName(again)
