"""WARC archives: write captures, read them back, assemble transactions.

``write_captures`` writes three records per page: a request, a response (or a revisit of an
equal payload) and a metadata record, the last two concurrent to the request. Spark's text
writer makes the files (gzip, the record terminator as line separator), so they go through
the commit protocol to any file system Spark can write. ``read_records`` parses archives by
Content-Length, and ``assemble`` joins the records of a transaction through their
concurrent-to identifiers into one nested row per capture.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .frames import ship

# Fixed values of the WARC 1.1 format.
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: Payload bytes and captures written to one file, at most (or one capture): they bound what a
#: reading task holds.
FILE_BYTES, CAPTURES_PER_FILE = 256 << 20, 4096
RECORDS_PER_BATCH = 1024

RECORD_SCHEMA = ("record_id string, record_type string, concurrent_to string, refers_to_id string, "
                 "target_uri string, date string, payload_bytes long, payload_digest string, "
                 "digest_valid boolean, fields map<string,string>")


def _urn(kind: str, *parts: Column) -> Column:
    """A record identifier made from its parts (null parts are told from empty ones)."""
    texts = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    h = F.md5(F.concat_ws("|", F.lit(kind), *texts).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _head(**fields: Column) -> Column:
    """Header lines ``Name: value`` for the fields that are not null."""
    lines = [F.concat(F.lit(k.replace("_", "-") + ": "), v) for k, v in fields.items()]
    return F.concat_ws(CRLF, *lines)


def _record(kind: Column, rid: Column, block: Column, content_type: str, **fields: Column) -> Column:
    head = _head(WARC_Type=kind, WARC_Record_ID=rid, **fields, Content_Type=F.lit(content_type),
                 Content_Length=F.octet_length(block).cast("string"))
    return F.concat(F.lit("WARC/1.1" + CRLF), head, F.lit(RECORD_END), block)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html not null) with ``payload_bytes``, ``payload_digest`` and
    ``first_page``, the smallest page_id with an equal payload of at least ``min_bytes``
    (null where the page is that one or has no equal)."""
    keyed = pages.withColumns({"payload_bytes": F.octet_length("html").cast("long"),
                               "payload_digest": F.sha2("html", 256)})
    narrow = keyed.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest")
    first = (narrow.groupBy("payload_digest").agg(F.min("page_id").alias("first_page"),
                                                  F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("payload_digest", "first_page"))
    # Only pages that revisit another one meet the pages with their html, by page.
    later = (narrow.join(first, "payload_digest")
             .where(~F.col("page_id").eqNullSafe(F.col("first_page"))).distinct()
             .select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "first_page"))
    on = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    return keyed.join(later, on, "left").drop("_id", "_digest")


def capture_records(keyed: DataFrame, date: str) -> DataFrame:
    """The text of each capture's three records, one row each."""
    # A header value holds no line break; a target URI none either, it is percent-encoded.
    uri = F.regexp_replace(F.col("url"), "[\\x00-\\x20]", "%20")
    request = _urn("request", F.col("page_id"), F.monotonically_increasing_id())
    revisit = F.col("first_page").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
                          + "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    about = {"WARC_Date": F.lit(date), "WARC_Target_URI": uri}
    path = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z]+://[^/]*(/[^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z]+://([^/]*)", 1), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path),
                   F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(RECORD_END))
    fields = F.concat(_head(page_id=F.col("page_id").cast("string"),
                            payload_bytes=F.col("payload_bytes").cast("string")), F.lit(CRLF))
    named = keyed.withColumns({
        "_request": request,
        "_answer": _urn("response", F.col("page_id"), F.col("payload_digest"), F.col("first_page"))})
    answer = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.col("_answer"),
        F.when(revisit, http).otherwise(F.concat(http, F.col("html"))),
        "application/http;msgtype=response", **about, WARC_Concurrent_To=F.col("_request"),
        WARC_Payload_Digest=F.concat(F.lit("sha256:"), F.col("payload_digest")),
        WARC_Profile=F.when(revisit, F.lit(REVISIT_PROFILE)),
        WARC_Refers_To=F.when(revisit, _urn("response", F.col("first_page"), F.col("payload_digest"),
                                            F.lit(None).cast("long"))))
    asked = _record(F.lit("request"), F.col("_request"), ask, "application/http;msgtype=request", **about)
    told = _record(F.lit("metadata"), _urn("metadata", F.col("_request")), fields, "application/warc-fields",
                   **about, WARC_Concurrent_To=F.col("_request"))
    return named.select(F.explode(F.array(asked, answer, told)).alias("value"))


def write_captures(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = "2026-01-01T00:00:00Z",
                   captures_per_file: int = CAPTURES_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Write one transaction per row of ``pages`` below ``path`` (gzip files), captures of a size
    class (a power of four) together, so many in a file that it stays below ``file_bytes``.

    A null html is an empty payload; null ids and urls leave their header out; of equal
    payloads of at least 100 bytes the smallest page_id (null counts as the largest) is the
    response and the others revisit it; rows that tie for it are all responses. Repeated rows
    are captures of their own, an empty table writes no record, other columns are ignored.
    """
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    # class k: payloads of at most small * 4^k bytes; one class for most tables
    small = max(1, file_bytes // captures_per_file)
    over = F.ceil(F.log(4.0, F.greatest(F.octet_length("html"), F.lit(small)) / float(small))).cast("int")
    found = sorted(r[0] for r in narrow.select(over.alias("k")).distinct().collect()) or [0]
    for n, k in enumerate(found):
        part = with_revisits(narrow).withColumn("k", over).where(F.col("k") == k).drop("k") if len(found) > 1 else with_revisits(narrow)
        (capture_records(part, date).write.format("text").mode("append" if n else "errorifexists")
         .option("lineSep", RECORD_END).option("compression", "gzip")
         .option("maxRecordsPerFile", 3 * max(1, captures_per_file // 4 ** k)).save(path))


# ------------------------------------------------------------------ reading
def _plain(content: bytes) -> Iterator[bytes]:
    """The content of a file, decompressed piece by piece; gzip members may follow another."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = memoryview(content)
    while len(rest):
        member = zlib.decompressobj(31)
        used = 0
        while used < len(rest) and not member.eof:
            yield member.decompress(rest[used: used + (1 << 20)])
            used += 1 << 20
        rest = rest[min(used, len(rest)) - len(member.unused_data):] if member.eof else rest[:0]


def _records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header, block) of each record; the block has Content-Length bytes, whatever is in it."""
    held, pieces = bytearray(), _plain(content)

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    at = 0
    while need(at + 1):
        if held[at] in b"\r\n":
            at += 1
            continue
        end = -1
        seen = at
        while (end := held.find(b"\r\n\r\n", max(at, seen - 3))) < 0:
            seen = len(held)
            if not need(len(held) + 1):
                raise ValueError("an archive ends within a record header")
        lines = bytes(held[at:end]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head.get("content-length", 0))
        if not need(end + 4 + size):
            raise ValueError("an archive ends within a record")
        yield head, bytes(held[end + 4: end + 4 + size])
        del held[:end + 4 + size]
        at = 0


def _row(head: dict, block: bytes, with_payload: bool) -> dict:
    kind = head.get("warc-type")
    declared = head.get("warc-payload-digest", "").partition(":")[2] or None
    row = {"record_id": head.get("warc-record-id"), "record_type": kind,
           "concurrent_to": head.get("warc-concurrent-to"), "refers_to_id": head.get("warc-refers-to"),
           "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"),
           "payload_bytes": None, "payload_digest": None, "digest_valid": None, "fields": None}
    if with_payload:
        row["payload"] = None
    if kind in ("response", "revisit"):
        top, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            digest = sha256(payload).hexdigest()
            row |= {"payload_bytes": len(payload), "payload_digest": digest,
                    "digest_valid": declared is None or declared == digest}
            if with_payload:
                row["payload"] = payload
        else:
            sizes = [x.partition(b":")[2] for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            row |= {"payload_bytes": int(sizes[0]) if sizes else None, "payload_digest": declared}
    elif kind == "metadata":
        row["fields"] = [(k.strip(), v.strip()) for k, _, v in
                         (x.partition(":") for x in block.decode("utf-8").split(CRLF) if x)]
    return row


def read_records(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path`` (``.warc`` or ``.gz``), one row each. A response
    has its payload's size and digest, computed anew; a revisit those of its header. A broken
    archive fails the read. ``with_payload`` adds the payload bytes of responses."""
    ship(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*{.gz,.warc}").option("recursiveFileLookup", "true")
             .load(path).select("content"))
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()),
             ("refers_to_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_valid", pa.bool_()),
             ("fields", pa.map_(pa.string(), pa.string()))] + [("payload", pa.binary())] * with_payload
    arrow = pa.schema(kinds)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in _records(content.as_py()):
                    rows.append(_row(head, block, with_payload))
                    if len(rows) == RECORDS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return files.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``request``, ``response`` (a response or
    revisit) and ``metadata`` structs and ``n_records``.

    A record belongs to the record it is concurrent to, or to that one's own when it is
    concurrent to another in turn (metadata to a response to a request, or a request to a
    response). A missing part is null; of several records of a kind in a capture the one with
    the smallest identifier is kept. Records are combined before the shuffle, so a capture
    with very many records gathers nowhere.
    """
    steps = (records.where("concurrent_to IS NOT NULL")
             .select(F.col("record_id").alias("_from"), F.col("concurrent_to").alias("_to")).distinct())
    hops = (records.where("record_type = 'metadata' AND concurrent_to IS NOT NULL")
            .join(steps, F.col("concurrent_to") == F.col("_from"), "left")
            .withColumn("capture_id", F.coalesce("_to", "concurrent_to")).drop("_from", "_to"))
    rest = (records.where("NOT (record_type <=> 'metadata' AND concurrent_to IS NOT NULL)")
            .withColumn("capture_id", F.coalesce("concurrent_to", "record_id")))
    every = rest.unionByName(hops)
    part = F.struct(*[c for c in records.columns if c != "record_type" and c != "fields"])
    kind = F.col("record_type")
    answer = F.struct("record_id", "record_type", *[c for c in records.columns
                                                    if c not in ("record_id", "record_type", "fields")])
    told = F.struct("record_id", F.map_entries("fields").alias("entries"))
    out = every.groupBy("capture_id").agg(
        F.min(F.when(kind == "request", part)).alias("request"),
        F.min(F.when(kind.isin("response", "revisit"), answer)).alias("response"),
        F.min(F.when(kind == "metadata", told)).alias("metadata"),
        F.count(F.lit(1)).alias("n_records"))
    return out.withColumn("metadata", F.struct(F.col("metadata.record_id").alias("record_id"),
                                               F.map_from_entries("metadata.entries").alias("fields")))


def page_digests(captures: DataFrame) -> DataFrame:
    """The digest columns of assembled captures: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type`` and, for a revisit, the page_id of the response that it
    refers to."""
    flat = captures.where("response IS NOT NULL").select(
        F.element_at("metadata.fields", "page-id").cast("long").alias("page_id"),
        "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.col("response.record_id").alias("_id"), F.col("response.refers_to_id").alias("_refers"))
    named = (flat.where("record_type = 'response'")
             .groupBy(F.col("_id").alias("_target")).agg(F.min("page_id").alias("refers_to")))
    return (flat.join(named, F.col("_refers") == F.col("_target"), "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder, read them back, assemble."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc") + "/archives"
    write_captures(pages, path)
    return page_digests(assemble(read_records(spark, path, with_payload=False)))
