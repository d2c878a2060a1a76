"""Legacy ARC archives to WARC, and both read back.

An ARC file is a chain of version blocks (`filedesc://` records), each followed by records whose
header line has the fields of that version: URL, IP, date, type and length in version 1; result
code, checksum, location, offset and file name besides in version 2. The parser walks by the
declared lengths, never by searching for the next header, so payloads may hold anything. The
converter gives every record a WARC identifier (a UUID of URL, date, place and digest, the same
on every attempt), an ISO timestamp from the 8 to 14 digits of the ARC date, a type (warcinfo
for version blocks, response for HTTP blocks, resource for others) and block and payload
digests; of records with equal payloads of at least `revisit_bytes` bytes that with the largest
order is kept whole and the others become revisit records that name it.

Archives are written and read by Spark (text sink of whole segments; binaryFile source), so they
may be in any store that Spark reaches. Every record is a gzip member of its own, so that readers
can start at any of them. Files hold at most SEGMENTS segments of about SEGMENT_BYTES, or one larger
record. Only keys, digests and lengths are shuffled to find equal payloads; hot payloads are
pre-aggregated, and a file, still compressed, meets the list of its records that are revisits.

Defined results: a null payload is written as an empty one; null URLs become `urn:unknown`, and
blanks and controls in URLs are percent-encoded; records of equal order and payload are told
apart by file and offset, the last staying a response; an empty table gives empty archives and
an empty result; other columns of the input, whatever their names, are not read. An archive that
breaks off, has a header of the wrong form or a length that is no number or negative is read up to
there: the rest of it cannot be told into records and becomes one metadata record that says where
and why, without order, payload or URL.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES, SEGMENTS = 4 << 20, 16
#: A header line that is longer is none.
LINE_BYTES = 1 << 20
#: The fields of a record's header line by version.
ARC_FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
#: Field names as version blocks spell them.
ARC_NAMES = {"1": "URL IP-address Archive-date Content-type Archive-length", "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class Stream:
    """Lines and exact counts of bytes from an archive, unzipped if it is gzip of any number of members."""

    def __init__(self, content: bytes, step: int = 1 << 16):
        self._pieces = self._unzipped(content, step) if content[:2] == b"\x1f\x8b" else iter([content])
        self._held, self._at, self.offset = b"", 0, 0

    @staticmethod
    def _unzipped(content: bytes, step: int) -> Iterator[bytes]:
        view, at, inflate = memoryview(content), 0, None
        left = b""
        while at < len(view) or left:
            if inflate is None or inflate.eof:
                if inflate is not None and not left and at >= len(view):
                    return
                inflate = zlib.decompressobj(31)
            raw = left or bytes(view[at : at + step])
            if not left:
                at += len(raw)
            out = inflate.decompress(raw, step * 4)
            left = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if out:
                yield out
        if inflate is not None and not inflate.eof:
            yield inflate.flush()
            raise ValueError("a gzip member breaks off")

    def _more(self) -> bool:
        piece = next(self._pieces, None)
        if piece is None:
            return False
        self._held, self._at = self._held[self._at :] + piece, 0
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        seek = self._at
        while (end := self._held.find(b"\n", seek)) < 0:
            had = len(self._held) - self._at
            if had > LINE_BYTES:
                raise ValueError("no end of a header line")
            if not self._more():
                if not had:
                    return None
                end = len(self._held)
                break
            seek = self._at + had
        out = self._held[self._at : end]
        self.offset += min(end + 1, len(self._held)) - self._at
        self._at = min(end + 1, len(self._held))
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        if n < 0:
            raise ValueError(f"negative length {n}")
        parts, short = [], n
        while short:
            if self._at == len(self._held) and not self._more():
                raise ValueError(f"ends {short} bytes before a declared length")
            part = self._held[self._at : self._at + short]
            parts.append(part)
            short -= len(part)
            self._at += len(part)
        self.offset += n
        return b"".join(parts)


def broken(offset: int, why: Exception) -> dict:
    """The record for an archive's rest that cannot be read."""
    return {"url": None, "ip": None, "date": "19700101000000", "type": None, "offset": offset, "block": f"archive broken at {offset}: {why}".encode(), "broken": True}


def read_arc(content: bytes) -> Iterator[dict]:
    """The records of an ARC archive: the header's fields, version, offset and block; version blocks have the url filedesc://…; if it is broken, the last says so."""
    offset = 0
    try:
        for record in _arc_records(content):
            yield record
            offset = record["end"]
    except (ValueError, zlib.error) as why:
        yield broken(offset, why)


def _arc_records(content: bytes) -> Iterator[dict]:
    stream, version = Stream(content), "1"
    while True:
        offset, line = stream.offset, stream.line()
        if line is None:
            return
        if not line.strip():
            continue
        fields = line.decode("utf-8", "surrogateescape").split(" ")
        if line.startswith(b"filedesc://"):
            block = stream.take(int(fields[-1]))
            version = block.split(b" ", 1)[0].decode("ascii", "replace")
            names = ARC_FIELDS["1"] if len(fields) == 5 else ARC_FIELDS["2"]
        else:
            names = ARC_FIELDS.get(version, ARC_FIELDS["1"])
            block = None
        if len(fields) != len(names):
            raise ValueError(f"not a header of version {version}: {line[:80]!r}")
        record = dict(zip(names, fields)) | {"version": version, "offset": offset}
        block = stream.take(int(record["length"])) if block is None else block
        yield record | {"block": block, "end": stream.offset, "broken": False}


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:unknown"


def member(data: bytes) -> bytes:
    """data as a gzip member; one of 16 MB or more is followed by an empty member, so that the last byte is always 0."""
    squeeze = zlib.compressobj(6, wbits=31)
    out = squeeze.compress(data) + squeeze.flush()
    return out if out.endswith(b"\0") else out + member(b"")


def arc_segment(records: Iterable[tuple[str | None, int | None, bytes]], version: str, name: str, date: str = "20240101000000", wrap: Callable[[bytes], bytes] = bytes) -> bytes:
    """A version block and HTTP records of (url, order, payload), each in wrap."""
    about = f"{version} 0 veinstone\n{ARC_NAMES[version]}\n\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain"
    first = (f"{head} {len(about)}\n" if version == "1" else f"{head} 200 - - 0 {name} {len(about)}\n").encode() + about
    out, size = [wrap(first)], len(first)
    for url, order, payload in records:
        mark = f"X-Order: {order}\r\n" if order is not None else ""
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        head = f"{safe_url(url)} 0.0.0.0 {date} text/html"
        line = f"{head} {len(block)}\n" if version == "1" else f"{head} 200 {hashlib.md5(payload).hexdigest()} - {size} {name} {len(block)}\n"
        whole = line.encode("utf-8", "surrogateescape") + block + b"\n"
        out.append(wrap(whole))
        size += len(whole)
    return b"".join(out)


def http_parts(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """The headers (lower-case names) and the payload of an HTTP response block; None if it isn't one."""
    if not block.startswith(b"HTTP/"):
        return None
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        head, _, payload = block.partition(b"\n\n")
    lines = head.decode("latin-1").splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def number(digits: str | None) -> int | None:
    return int(digits) if digits and re.fullmatch(r"-?[0-9]{1,19}", digits) and -(1 << 63) <= int(digits) < 1 << 63 else None


def described(record: dict) -> dict:
    """What the converter needs to know of an ARC record besides its block."""
    parts = None if record["broken"] else http_parts(record["block"])
    payload = parts[1] if parts else record["block"]
    order = parts[0].get("x-order", "") if parts else ""
    kind = "metadata" if record["broken"] else "warcinfo" if record["url"].startswith("filedesc://") else "response" if parts else "resource"
    return {"url": record["url"], "ip": record["ip"], "date": record["date"], "mime": record["type"], "order": number(order), "digest": hashlib.sha1(payload).hexdigest(), "payload_bytes": len(payload), "kind": kind}


def iso_date(digits: str) -> str:
    d = (re.sub(r"\D", "", digits) + "00000101000000"[len(re.sub(r"\D", "", digits)) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str, file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {date} {digest} {file} {offset}')}>"


def base32_sha1(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def hexadecimal(digest: str | None) -> str | None:
    """The hex digits of a digest in base 32, with or without its name; null if it is none of SHA-1."""
    code = (digest or "").rpartition(":")[2].upper()
    return base64.b32decode(code).hex() if re.fullmatch("[A-Z2-7]{32}", code) else None


def warc_record(block: bytes, file: str, offset: int, about: dict, refers: dict | None = None) -> bytes:
    """The WARC record for an ARC record; refers: url, date, digest, file, offset and order of the response that a revisit names."""
    kind = "revisit" if refers else about["kind"]
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(about["url"], about["date"], about["digest"], file, offset)), ("WARC-Date", iso_date(about["date"]))]
    if kind == "warcinfo":
        block = b"software: veinstone\r\nformat: WARC File Format 1.0\r\narc-description: " + about["url"].encode("utf-8", "surrogateescape") + b"\r\n"
    elif kind != "metadata":
        headers += [("WARC-Target-URI", about["url"]), ("WARC-IP-Address", about["ip"]), ("WARC-Payload-Digest", base32_sha1(about["digest"])), ("X-Payload-Length", about["payload_bytes"])]
    if refers:
        block = block[: len(block) - about["payload_bytes"]]
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers["url"], refers["date"], about["digest"], refers["file"], refers["offset"])), ("WARC-Refers-To-Target-URI", refers["url"]), ("WARC-Refers-To-Date", iso_date(refers["date"]))]
        if refers["order"] is not None:
            headers += [("X-Refers-To-Order", refers["order"])]
    if about["order"] is not None:
        headers += [("X-Order", about["order"])]
    kinds = {"warcinfo": "application/warc-fields", "metadata": "text/plain", "resource": about["mime"]}
    headers += [("WARC-Block-Digest", base32_sha1(hashlib.sha1(block).hexdigest())), ("Content-Type", kinds.get(kind, "application/http; msgtype=response")), ("Content-Length", len(block))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by declared lengths; if the archive is broken, the last is a metadata record that says so."""
    offset = 0
    try:
        for headers, block, offset in _warc_records(content):
            yield headers, block
    except (ValueError, KeyError, zlib.error) as why:
        yield {"warc-type": "metadata"}, broken(offset, why)["block"]


def _warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    stream = Stream(content)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:80]!r}")
        headers = {}
        while line := stream.line():
            k, _, v = line.decode("utf-8", "surrogateescape").partition(":")
            headers[k.strip().lower()] = v.strip()
        yield headers, stream.take(int(headers["content-length"])), stream.offset


def _segments(records: Iterable[bytes]) -> Iterator[bytes]:
    """Members one after another, in pieces of about SEGMENT_BYTES or one larger record."""
    held, size = [], 0
    for record in records:
        if held and size + len(record) > SEGMENT_BYTES:
            yield b"".join(held)
            held, size = [], 0
        held.append(member(record))
        size += len(record)
    if held:
        yield b"".join(held)


def _sink(segments: DataFrame, path: str) -> None:
    """Segments one after another in files. The text sink ends each with a separator: a segment's last byte, which is always 0."""
    segments.select(F.col("value").cast("string")).write.option("compression", "none").option("lineSep", "\0").option("maxRecordsPerFile", SEGMENTS).text(path)


def _packed(segment: bytes) -> pa.RecordBatch:
    return pa.record_batch({"value": pa.array([segment[:-1]], pa.binary())})


def _source(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _binary(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    col = batch.column(name)
    return (x.as_py() or b"" for x in (col.cast(pa.binary()) if pa.types.is_string(col.type) else col))


def write_arc(rows: DataFrame, path: str, url: str = "url", order: str = "page_id", payload: str = "html") -> None:
    """rows as ARC files of versions 1 and 2 in turn, a gzip member a record."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0

        def out(held: list) -> pa.RecordBatch:
            return _packed(arc_segment(held, "12"[turn % 2], f"segment-{turn}.arc", wrap=member))

        held, size = [], 0
        for batch in batches:
            for u, o, p in zip(batch.column("u").to_pylist(), batch.column("o").to_pylist(), _binary(batch, "p")):
                if held and size + len(p) > SEGMENT_BYTES:
                    yield out(held)
                    held, size, turn = [], 0, turn + 1
                held.append((u, o, p))
                size += len(p) + 256
        if held:
            yield out(held)

    _sink(rows.select(F.col(url).alias("u"), F.col(order).cast("long").alias("o"), F.col(payload).alias("p")).mapInArrow(pack, "value binary"), path)


META = "file string, offset long, url string, ip string, date string, mime string, `order` long, digest string, payload_bytes long, kind string"


def arc_records(spark: SparkSession, path: str) -> DataFrame:
    """What describes the records of the ARC archives under path, their blocks aside."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "offset", "url", "ip", "date", "mime", "order", "digest", "payload_bytes", "kind"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        make = lambda held: pa.record_batch([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names=names)
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), _binary(batch, "content")):
                held = []
                for r in read_arc(content):
                    held.append(described(r) | {"file": file, "offset": r["offset"]})
                    if len(held) >= 4096:
                        yield make(held)
                        held = []
                if held:
                    yield make(held)

    return _source(spark, path).mapInArrow(parse, META)


def convert(spark: SparkSession, arc: str, warc: str, revisit_bytes: int = 1000) -> None:
    """The ARC archives under arc as WARC archives under warc."""
    meta = arc_records(spark, arc)
    place = F.struct(F.coalesce("order", F.lit(-(2**62))).alias("rank"), "file", "offset", "url", "date", "order")
    large = meta.where(F.col("kind").isin("response", "resource") & (F.col("payload_bytes") >= revisit_bytes))
    kept = large.groupBy("digest").agg(F.max(place).alias("to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "to")
    again = large.select("file", "offset", "digest").join(kept, "digest").where((F.col("file") != F.col("to.file")) | (F.col("offset") != F.col("to.offset")))
    # a file's records are bounded by its size
    by_file = again.groupBy("file").agg(F.collect_list(F.struct("offset", "to")).alias("revisits"))
    files = _source(spark, arc).join(by_file, "file", "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for k, (file, content) in enumerate(zip(batch.column("file").to_pylist(), _binary(batch, "content"))):
                    to = {r["offset"]: r["to"] for r in batch.column("revisits")[k].as_py() or ()}
                    for r in read_arc(content):
                        yield warc_record(r["block"], file, r["offset"], described(r), to.get(r["offset"]))

        for segment in _segments(records()):
            yield _packed(segment)

    _sink(files.mapInArrow(pack, "value binary"), warc)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """Per response, revisit, resource or metadata record: what its headers and, for whole payloads, its bytes say."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in _binary(batch, "content"):
                rows = []
                for h, block in read_warc(content):
                    if h.get("warc-type", "warcinfo") == "warcinfo":
                        continue
                    if h["warc-type"] == "metadata":
                        rows.append({"record_type": "metadata", "record_id": h.get("warc-record-id"), "warc_date": h.get("warc-date"), "note": block.decode("utf-8", "replace")})
                        continue
                    declared = hexadecimal(h.get("warc-payload-digest"))
                    parts = http_parts(block) if h["warc-type"] != "resource" else None
                    payload = parts[1] if parts else block
                    whole = h["warc-type"] != "revisit"
                    digest = hashlib.sha1(payload).hexdigest() if whole else declared
                    rows.append({
                        "order": number(h.get("x-order")), "payload_bytes": len(payload) if whole else number(h.get("x-payload-length")), "payload_digest": digest, "record_type": h["warc-type"],
                        "refers_to": number(h.get("x-refers-to-order")), "digests_agree": digest == declared and base32_sha1(hashlib.sha1(block).hexdigest()) == h.get("warc-block-digest"),
                        "url": h.get("warc-target-uri"), "record_id": h.get("warc-record-id"), "refers_to_id": h.get("warc-refers-to"), "warc_date": h.get("warc-date"),
                    })
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema([("order", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digests_agree", pa.bool_()), ("url", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("warc_date", pa.string()), ("note", pa.string())])
    return _source(spark, path).mapInArrow(parse, "`order` long, payload_bytes long, payload_digest string, record_type string, refers_to long, digests_agree boolean, url string, record_id string, refers_to_id string, warc_date string, note string")
