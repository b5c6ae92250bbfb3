"""Legacy archive converter: ARC files of either version become WARC files.

An ARC record is a header line whose fields depend on the version that the file's first
record declares, and as many bytes as the line says. The converter reads both versions
by those declared lengths, synthesises WARC identifiers, timestamps, types and digests,
and writes a repeated payload as a ``revisit`` of the first record that has it.

Files are the unit of work: each is parsed and written by one task, the decisions on
repeated payloads are made on digests alone and joined to the files by path. Spark's own
readers and writers do all file access (``binaryFile`` and ``text``, whose line separator
supplies a record's last byte). Files roll after ``RECORDS`` records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.llm.common import rows_of, stored, table
from ledgerhawk.session import scratch_path

RECORDS = 4000
LEAST_PAYLOAD = 100
DATE = "20240101000000"

# --- fixed values: field lines of the two ARC versions
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# ----------------------------------------------------


def inflate(data: bytes) -> bytes:
    """Content of a file, whether plain or one or several gzip members."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        out.append(member.flush())
        if not member.eof:
            raise ValueError("truncated gzip member")
        data = member.unused_data
    return b"".join(out) if out else data


def parse_arc(data: bytes) -> Iterator:
    """Records ``offset, version, fields, content`` of one ARC file; the version record
    sets how the lines after it are read. A file that lacks it is taken as version 1.

    Spaces inside a URL are allowed: fields are counted from the line's end. A declared
    length beyond the file's end is an error, as is a line that is no header."""
    at, version = 0, 1
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].rstrip(b"\r")
        first = line.startswith(b"filedesc://")
        parts = line.decode("utf-8", "surrogateescape").split(" ") if first else \
            line.decode("utf-8", "surrogateescape").rsplit(" ", FIELDS[version].count(" "))
        if end < 0 or len(parts) < 5 or not parts[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {at}")
        start, size = end + 1, int(parts[-1])
        if start + size > len(data):
            raise ValueError(f"the record at byte {at} declares {size} bytes, the file ends before")
        content = data[start:start + size]
        if first:
            said = content.split(b" ", 1)[0]
            if said not in (b"1", b"2"):
                raise ValueError(f"unknown ARC version {said!r}")
            version = int(said)
        names = FIELDS[1 if first else version].split(" ")
        yield at, version, dict(zip(names, [*parts[:len(names) - 1], parts[-1]])), content
        at = start + size


def http_parts(content: bytes) -> tuple:
    """Head and payload of an HTTP message; a block without a status line is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    m = re.search(rb"\r?\n\r?\n", content)
    return (content[:m.end()], content[m.end():]) if m else (content, b"")


def header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m and m[1] else None


def record_id(path: str, offset: int, fields: dict) -> str:
    """A name that the same record gets again whenever it is converted."""
    seed = "\n".join([path.rsplit("/", 1)[-1], str(offset), fields["URL"], fields["Archive-date"]])
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(seed.encode('utf-8', 'surrogateescape')).digest()[:16], version=4)}>"


def iso_date(stamp: str) -> str:
    """14-digit stamps as WARC dates; shorter ones are filled with the earliest values."""
    s = re.sub("[^0-9]", "", stamp)[:14]
    s = s + "00000101000000"[len(s):]
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:]}Z"


def warc_record(kind: str, name: str, fields: dict, content: bytes, refers: str | None = None) -> bytes:
    """One WARC record without its last byte (the writer's line separator)."""
    head, payload = http_parts(content)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {iso_date(fields['Archive-date'])}"]
    if kind == "warcinfo":
        block, media = content, "application/warc-fields"
    else:
        lines.append(f"WARC-Target-URI: {fields['URL']}")
        if fields["IP-address"] not in ("-", "0.0.0.0"):
            lines.append(f"WARC-IP-Address: {fields['IP-address']}")
        lines.append(f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}")
        block = content
        media = "application/http; msgtype=response" if head else fields["Content-type"]
        if kind == "revisit":
            block = head
            lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers}"]
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogateescape") + block + b"\r\n\r"


def parse_warc(data: bytes) -> Iterator:
    """Records ``headers, block`` of one WARC file, by their declared lengths."""
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        start, size = end + 4, int(fields["content-length"])
        if data[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, data[start:start + size]
        at = start + size + 4


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def _write(rows: DataFrame, path: str) -> None:
    """Records as files; compression is gzip, one member a file."""
    rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", RECORDS) \
        .option("compression", "gzip").option("lineSep", "\n").text(path)


def _batches(records: Iterator, size: int = 1 << 23) -> Iterator:
    import pyarrow as pa
    held, total = [], 0
    for r in records:
        held.append(r)
        total += len(r)
        if total >= size:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])


def write_arc(pages: DataFrame, path: str, versions: tuple = (1, 2)) -> None:
    """Pages as ARC files, the versions taking turns by task. The payload is the html in
    UTF-8 behind an HTTP head that keeps the page_id; a null url becomes ``urn:none``."""
    src = pages.select(F.col("page_id").cast("string"), "url", "html", F.spark_partition_id().alias("task"))

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import warc

        def records() -> Iterator:
            n = 0
            for b in rows_of(batches, 512):
                for page, url, html, task in zip(*(c.to_pylist() for c in b.columns)):
                    version = versions[task % len(versions)]
                    if n % (RECORDS - 1) == 0:
                        desc = f"{version} 0 pages\n{warc.FIELDS[version]}\n\n".encode()
                        yield f"filedesc://{task}.arc 0.0.0.0 {DATE} text/plain {len(desc)}\n".encode() + desc
                    n += 1
                    body = (html or "").encode("utf-8", "surrogatepass")
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Page-Id: {page or ''}\r\n\r\n".encode()
                    where = re.sub(r"\s", "%20", url or "") or "urn:none"
                    more = "" if version == 1 else "200 - - 0 - "
                    yield f"{where} 0.0.0.0 {DATE} text/html {more}{len(head) + len(body)}\n".encode("utf-8", "surrogatepass") + head + body

        yield from warc._batches(records())

    _write(src.mapInArrow(run, "value binary"), path)


INDEX = "path string, offset long, record string, page string, payload_bytes long, digest string"


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the ARC files: where it is, its WARC name, its page and the
    length and SHA-256 of its payload."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm import warc
        for b in rows_of(batches, 1):
            name, content = b.column(0)[0].as_py(), b.column(1)[0].as_py()
            rows = []
            for offset, _, fields, block in warc.parse_arc(warc.inflate(content)):
                if fields["URL"].startswith("filedesc://"):
                    continue
                head, payload = warc.http_parts(block)
                rows.append((name, offset, warc.record_id(name, offset, fields), warc.header(head, "X-Page-Id"),
                             len(payload), hashlib.sha256(payload).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i != 3 else pa.array(c, pa.string())
                                                  for i, c in enumerate(zip(*rows))], [x.split()[0] for x in INDEX.split(", ")])

    return _files(spark, path).mapInArrow(run, INDEX)


def _rank(page: Column) -> Column:
    """Smallest page first: numbers, then other names, then none."""
    number = F.expr("try_cast(page as long)")
    return F.struct(page.isNull().alias("none"), number.isNull().alias("name"), number.alias("number"), page.alias("page"),
                    F.col("path").alias("path"), F.col("offset").alias("offset"), F.col("record").alias("record"))


def revisits(index: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``path, again``: for every file the records that repeat an earlier page's payload
    of at least ``least`` bytes, with the record they refer to."""
    large = index.where(F.col("payload_bytes") >= least)
    firsts = large.groupBy("digest").agg(F.min(_rank(F.col("page"))).alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("digest", F.col("first.record").alias("refers"))
    return (large.join(firsts, "digest").where("record != refers").groupBy("path")
            .agg(F.collect_list(F.struct("offset", "refers")).alias("again")))


def arc_to_warc(spark: SparkSession, source: str, target: str, least: int = LEAST_PAYLOAD) -> None:
    """Convert every ARC file below ``source``. HTTP responses become ``response`` or
    ``revisit`` records, other records ``resource``, version records ``warcinfo``."""
    again = revisits(stored(arc_index(spark, source), "arc-index"), least)
    files = _files(spark, source).join(again, "path", "left").select("path", "content", "again")

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import warc

        def records() -> Iterator:
            for b in rows_of(batches, 1):
                name, content, again = (c[0].as_py() for c in b.columns)
                refers = {x["offset"]: x["refers"] for x in again or ()}
                for offset, _, fields, block in warc.parse_arc(warc.inflate(content)):
                    own = warc.record_id(name, offset, fields)
                    if fields["URL"].startswith("filedesc://"):
                        yield warc.warc_record("warcinfo", own, fields, b"software: archive converter\r\nformat: WARC 1.1\r\n")
                    elif offset in refers:
                        yield warc.warc_record("revisit", own, fields, block, refers[offset])
                    else:
                        yield warc.warc_record("response" if block.startswith(b"HTTP/") else "resource", own, fields, block)

        yield from warc._batches(records())

    _write(files.mapInArrow(run, "value binary"), target)


RECORD = ("record string, kind string, uri string, date string, refers string, page string, "
          "payload_bytes long, digest string, said string")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response, revisit or resource record; length and digest are those of
    the payload in the record (null in revisits), ``said`` is the digest its header states."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm import warc
        kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in warc.RECORD.split(", ")]
        for b in rows_of(batches, 1):
            rows = []
            for f, block in warc.parse_warc(warc.inflate(b.column(1)[0].as_py())):
                kind = f["warc-type"]
                if kind == "warcinfo":
                    continue
                head, payload = warc.http_parts(block)
                own = kind != "revisit"
                rows.append((f["warc-record-id"], kind, f["warc-target-uri"], f["warc-date"], f.get("warc-refers-to"),
                             warc.header(head, "X-Page-Id"), len(payload) if own else None,
                             hashlib.sha256(payload).hexdigest() if own else None, f["warc-payload-digest"].split(":", 1)[1]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 [x.split()[0] for x in warc.RECORD.split(", ")])

    return _files(spark, path).mapInArrow(run, RECORD)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read back from
    the WARC files that the pages' ARC files were converted to.

    Null html is an empty payload. A page without an id is the last choice for the record
    others refer to. Of repeated rows with one payload the first stays a response. Other
    columns are not read; an empty table gives an empty result."""
    kind = pages.schema["page_id"].dataType.simpleString()
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    arc_to_warc(spark, arc, warc)
    read = stored(read_warc(spark, warc), "warc-index")
    whole = read.where("kind != 'revisit'")
    first = whole.select(F.col("record").alias("refers"), F.col("page").alias("refers_to"), "payload_bytes", "digest")
    again = read.where("kind = 'revisit'").select("page", "kind", "refers").join(first, "refers")
    cols = [F.col("page").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
            F.col("kind").alias("record_type")]
    return whole.select(*cols, F.lit(None).cast(kind).alias("refers_to")) \
        .unionByName(again.select(*cols, F.col("refers_to").cast(kind).alias("refers_to")))


def op10(spark, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` archived, converted and read back."""
    return archived(spark, table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id = coalesce(first, page_id) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
