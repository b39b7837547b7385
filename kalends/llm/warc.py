"""WARC archives: records with revisits and continuation segments, written and reassembled (operator 3)."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.llm.common import shared_folder, stored, write_settings

#: Fixed values of the format: version line, record types and the profile of a revisit.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), f"Content-Length: {len(block)}".encode(), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def _uri(page: object, digest: str) -> str:
    return f"urn:page:{'' if page is None else page}:{digest}"


def build_records(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, segment: int, chunk: int) -> bytes:
    """Records of one page: a revisit of page ``first``, or a response in segments of at most ``segment`` bytes, its payload in HTTP chunks."""
    own = f"<{_uri(page, digest)}#{uuid.uuid4()}>"
    target = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url or "") or None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    about = [("WARC-Target-URI", target), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_uri(first, digest)}>"), *about]
        return _record(fields, head + b"\r\n")
    framed = b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[k : k + chunk] for k in range(0, len(payload), chunk)))
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + framed + b"0\r\n\r\n"
    parts = [block[k : k + segment] for k in range(0, len(block), segment)]
    if len(parts) == 1:
        return _record([("WARC-Type", "response"), ("WARC-Record-ID", own), *about], block)
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Segment-Number", 1), *about], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total), ("WARC-Date", DATE)]
        out.append(_record(fields, part))
    return b"".join(out)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, least: int = 0, segment: int = 8192, chunk: int = 4096, most: int = 2000) -> None:
    """Write one record per page, WARC files of at most ``most`` pages, each one gzip stream, into ``folder`` of any file system of Spark.

    Payload is the text in UTF-8, empty for null. Of pages with equal payloads of at least ``least`` bytes the one with the
    largest id is the response and the others revisit it; rows that repeat that id are all responses, and null ids come
    before all others. Payloads are told apart by SHA-1 and length. The largest ids are pre-aggregated before they are joined.
    A record must fit in memory; a file holds whole pages with all their segments.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    keys = {"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")}
    rows = rows.withColumns(keys)
    first = rows.groupBy("digest", "size").agg(F.max("page_id").alias("first"))
    rows = rows.join(first, ["digest", "size"])
    revisit = (F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "digest", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"), "html")

    def records(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(at, 64).to_pylist():
                    digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                    data = build_records(r["page_id"], r["url"], r["html"].encode("utf-8"), digest, r["first"], r["revisit"], segment, chunk)
                    out.append(data[:-1])  # the writer ends each row with the line feed that ends a record
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = rows.mapInArrow(records, "value binary").select(F.col("value").cast("string").alias("value"))
    with write_settings(pages.sparkSession):
        lines.write.option("lineSep", "\n").option("maxRecordsPerFile", most).option("compression", "gzip").text(folder)


def parse(data: bytes):
    """Yield the fields and the block of each record of an archive; raises ``ValueError`` where it is broken."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if end < 0 or not lines[0].startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8")
        size = int(fields["content-length"])
        block = data[end + 4 : end + 4 + size]
        at = end + 8 + size
        if len(block) != size or data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} has another length than it says")
        yield fields, block


def dechunk(body: bytes) -> bytes:
    """Payload of chunked transfer framing, with extensions and trailers; raises ``ValueError`` where it is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size line")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            if not (body[end:] == b"\r\n\r\n" or body.endswith(b"\r\n\r\n")):
                raise ValueError("the last chunk has no end")
            return b"".join(out)
        part = body[end + 2 : end + 2 + size]
        at = end + 4 + size
        if len(part) != size or body[at - 2 : at] != b"\r\n":
            raise ValueError("a chunk has another length than it says")
        out.append(part)


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP message, without chunked framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("an HTTP head has no end")
    chunked = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:]))
    return dechunk(body) if chunked else body


RECORDS = "origin string, number int, total long, type string, uri string, digest string, refers string, block binary"
PAGES = "origin string, type string, digest string, refers string, size long, payload binary"


def _batches(rows, schema: str, least: int = 4 << 20):
    """Arrow batches of row tuples whose last value is bytes or null, of some ``least`` bytes each."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*((f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")))
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += 200 + len(row[-1] or b"")
        if size > least:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)


def _records(content: bytes, segmented: bool | None):
    for f, block in parse(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
        if segmented is None or segmented == ("warc-segment-number" in f):
            own, total = f["warc-record-id"], f.get("warc-segment-total-length")
            yield (
                f.get("warc-segment-origin-id", own), int(f.get("warc-segment-number", 0)), int(total) if total else None, f["warc-type"],
                f.get("warc-target-uri"), f.get("warc-payload-digest"), f.get("warc-refers-to"), block,
            )


def _page(origin: str, kind: str, digest: str | None, refers: str | None, block: bytes, keep: bool):
    """Row of ``PAGES`` for a whole record; a response's payload is unchunked and must have the digest that its head names."""
    payload = http_payload(block) if kind == "response" else None
    digest = (digest or "").removeprefix("sha1:")
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"the payload of {origin} has another digest")
    return origin, kind, digest, refers, None if payload is None else len(payload), payload if keep else None


def read_records(spark: SparkSession, folder: str, segmented: bool | None = None) -> DataFrame:
    """Records of the archives in ``folder``; ``origin`` and ``number`` place a segment, ``total`` is the length its last one names.

    A record that is not segmented has number 0; ``segmented`` chooses those with or without segments.
    """
    def run(batches):
        for batch in batches:
            yield from _batches((row for content in batch.column(0) for row in _records(content.as_py(), segmented)), RECORDS)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, RECORDS)


def reassemble(segments: DataFrame) -> DataFrame:
    """Group segments by their origin, in order of number, and check that none is missing and the total length holds.

    Returns ``type``, ``uri``, ``digest``, ``refers``, ``origin`` and ``block``; a broken group
    raises an error in the job. A group is one record, which must fit in memory.
    """
    parts = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"), F.count("total").alias("ends"),
        *(F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("type", "uri", "digest", "refers")),
    )
    blocks = F.transform("parts", lambda p: p["block"])
    size = F.aggregate(blocks, F.lit(0).cast("long"), lambda a, b: a + F.octet_length(b))
    numbers = F.transform("parts", lambda p: p["number"])
    sound = (F.col("ends") == 1) & (numbers == F.sequence(F.lit(1), F.size("parts"))) & (size == F.col("total"))
    joined = F.aggregate(blocks, F.lit(b""), lambda a, b: F.concat(a, b))
    checked = F.when(F.coalesce(sound, F.lit(False)), joined).otherwise(F.raise_error(F.concat(F.lit("segments do not fit together: "), F.col("origin"))).cast("binary"))
    return parts.select("origin", "type", "uri", "digest", "refers", checked.alias("block"))


def read_pages(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Pages of the archives: ``page_id``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` and, if wanted, ``payload`` (null for revisits).

    Only segments are shuffled. A response's length and digest are computed from its reassembled, unchunked payload and must
    equal the digest in its head; a revisit takes them from the response that it names, joined by name, and a missing one
    raises an error. What was read is written to the shared folder once.
    """
    def whole(batches):
        for batch in batches:
            yield from _batches((_page(o, k, d, f, b, payloads) for content in batch.column(0) for o, _, _, k, _, d, f, b in _records(content.as_py(), False)), PAGES)

    def joined(batches):
        for batch in batches:
            rows = (tuple(batch.column(c)[r].as_py() for c in ("origin", "type", "digest", "refers", "block")) for r in range(batch.num_rows))
            yield from _batches((_page(*row, payloads) for row in rows), PAGES)

    files = spark.read.format("binaryFile").load(folder).select("content")
    segments = reassemble(read_records(spark, folder, segmented=True))
    read = stored(files.mapInArrow(whole, PAGES).unionByName(segments.mapInArrow(joined, PAGES)), "pages")

    def page(name: Column) -> Column:
        return F.nullif(F.regexp_extract(name, "^<urn:page:([^:]*):", 1), F.lit("")).cast("long")

    sizes = read.where("type = 'response'").groupBy(F.regexp_replace("origin", "#[^#]*>$", ">").alias("refers")).agg(F.max("size").alias("found"))
    responses = read.where("type = 'response'").withColumn("found", F.col("size"))
    revisits = read.where("type = 'revisit'").join(sizes, "refers", "left")
    missing = F.raise_error(F.concat(F.lit("no response for "), F.col("origin"))).cast("long")
    return responses.unionByName(revisits).select(
        page(F.col("origin")).alias("page_id"), F.col("type").alias("record_type"), F.coalesce("found", missing).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.when(F.col("type") == "revisit", page(F.col("refers"))).alias("refers_to"), *(["payload"] if payloads else []),
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives that the whole cluster sees."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
