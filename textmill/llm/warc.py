"""WARC archives with a Zstandard dictionary, written and read back.

An archive starts with a skippable frame that holds the dictionary; each
record is one Zstandard frame of its own.  Tasks write their part as archives
of about ``ARCHIVE_BYTES``, under names fixed by partition and number, through
a temporary name: a repeated task writes the same file again.  The reader takes
archives through Spark's binary file source, loads the dictionary, walks the
frames by their block headers, decodes one frame per record and checks version,
needed headers, block length, record end and payload digest.

Which record is the response of a payload is decided on lean rows (id, digest):
minima are combined before the shuffle, and the page texts are joined by id and digest, so
a payload that a third of all pages share weighs on no single task.

Defined results: null and empty payloads are empty; equal payloads of at least
``min_payload`` bytes have one response, the smallest page_id (all rows of that
id, if it repeats), and revisits of it; a null id is always a response; a null
URL leaves its header out; line ends and controls in a URL are percent-encoded; an empty table gives
no archive and no rows; further columns are ignored.  One record must fit the 2 GB limit
of a Spark value.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table
from textmill.session import scratch_path

ARCHIVE_BYTES = 16_000_000
DICTIONARY_BYTES = 16_384
SAMPLE_BYTES = 1_000_000
#: Fixed values of the formats: skippable frame of a dictionary, Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; with ``refers_to`` a revisit, whose block has no payload."""
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    named = "" if page_id is None else str(page_id)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{named}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    head.append(("X-Payload-Length", str(len(payload))))
    if revisit:
        head += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace")
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one decoded record, checked."""
    head, end, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not end or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name != name.strip():
            raise WarcError(f"malformed header line {line[:60]!r}")
        headers[name.lower()] = value.strip()
    lacking = [n for n in _NEEDED if n.lower() not in headers]
    if lacking:
        raise WarcError(f"lacks {', '.join(lacking)}")
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise WarcError("block length differs from Content-Length")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    if not blank:
        raise WarcError("no HTTP header in the block")
    kind = headers["warc-type"]
    said = headers.get("warc-payload-digest", "")
    full = headers.get("x-payload-length", str(len(payload)))
    if kind == "response" and (said.removeprefix("sha1:") not in ("", payload_digest(payload)) or full != str(len(payload))):
        raise WarcError("payload differs from its digest or length")
    if kind == "revisit" and ("warc-refers-to" not in headers or not full.isdecimal()):
        raise WarcError("revisit without its response")
    return {"headers": headers, "type": kind, "payload": payload if kind == "response" else None,
            "digest": said.removeprefix("sha1:") or payload_digest(payload), "length": int(full)}


def frames(data: bytes):
    """(dictionary, iterator of whole frames) of an archive."""
    import zstandard

    view = memoryview(data)
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_MAGIC:
        raise WarcError("no leading dictionary frame")
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise WarcError("dictionary frame cut short")
    words = data[8:8 + size]
    if len(words) >= 4 and struct.unpack_from("<I", words)[0] == FRAME_MAGIC:  # the dictionary itself may be compressed
        words = zstandard.ZstdDecompressor().decompress(words)

    def walk():
        at = 8 + size
        while at < len(data):
            if at + 8 > len(data):
                raise WarcError("bytes after the last frame")
            magic = struct.unpack_from("<I", data, at)[0]
            if magic & 0xFFFFFFF0 == 0x184D2A50:
                at += 8 + struct.unpack_from("<I", data, at + 4)[0]
                continue
            if magic != FRAME_MAGIC:
                raise WarcError("no Zstandard frame where one has to start")
            checked = data[at + 4] & 4
            end, last = at + zstandard.frame_header_size(data[at:at + 18]), False
            while not last:
                if end + 3 > len(data):
                    raise WarcError("frame cut short")
                block = int.from_bytes(view[end:end + 3], "little")
                last, kind = block & 1, block >> 1 & 3
                end += 3 + (1 if kind == 1 else block >> 3)
            end += 4 if checked else 0
            if end > len(data):
                raise WarcError("frame cut short")
            yield data[at:end]
            at = end

    return words, walk()


def read_archive(data: bytes):
    """All records of an archive, one frame each."""
    import zstandard

    words, found = frames(data)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    for frame in found:
        try:
            raw = reader.decompress(frame, max_output_size=0, allow_extra_data=False)
        except zstandard.ZstdError as e:
            raise WarcError(f"frame does not decode: {e}") from e
        yield parse_record(raw)


def archive_start(samples: list[bytes]):
    """(compressor, leading frame): a dictionary trained on the archive's first
    records or, where they are too few for that, made of them."""
    import zstandard

    words = b""
    if samples:
        try:
            words = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            words = b"".join(samples)[:DICTIONARY_BYTES]
    shared = zstandard.ZstdCompressionDict(words) if words else None
    packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True, write_content_size=True)
    return packer, struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words


def archives(records, archive_bytes: int = ARCHIVE_BYTES):
    """Bytes of archives from an iterator of records."""
    waiting, size, out, packer, first = [], 0, None, None, b""
    for r in records:
        if packer is None:
            waiting.append(r)
            size += len(r)
            if size < SAMPLE_BYTES:
                continue
            packer, first = archive_start(waiting)
            out = bytearray(first)
            for w in waiting:
                out += packer.compress(w)
            waiting = []
        else:
            out += packer.compress(r)
        if len(out) >= archive_bytes:
            yield bytes(out)
            packer, size = None, 0
    if waiting:
        packer, first = archive_start(waiting)
        out = bytearray(first)
        for w in waiting:
            out += packer.compress(w)
    if packer is not None and len(out) > len(first):
        yield bytes(out)


def responses(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of every page that revisits an equal payload."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    lean = pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    lean = lean.filter(F.col("bytes") >= min_payload)
    first = lean.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    return (lean.join(first, "digest").filter("page_id <> refers_to")
            .select("page_id", "digest", "refers_to").distinct())


def write_warc(pages: DataFrame, folder: str, min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``;
    the number of records."""
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest")
    rows = (pages.select("page_id", "url", "html", digest)
            .join(responses(pages, min_payload), ["page_id", "digest"], "left")
            .select("page_id", "url", "html", F.col("refers_to").cast("string").alias("refers_to"))
            .sortWithinPartitions("page_id", "url", "html"))

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        n = [0]

        def records():
            for b in batches:
                for page_id, url, html, refers in zip(b["page_id"], b["url"], b["html"], b["refers_to"]):
                    n[0] += 1
                    yield record_bytes(page_id, url, (html or "").encode("utf-8", "replace"), refers)

        store, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        for i, data in enumerate(archives(records(), archive_bytes)):
            name = f"{root}/part-{part:05d}-{i:05d}.warc.zst"
            temporary = f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as f:
                f.write(data)
            store.move(temporary, name)
        yield {"records": [n[0]]}

    jvm = pages.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(pages.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return map_rows(rows, run, "records bigint").agg(F.sum("records")).first()[0] or 0


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives below ``folder``: page_id, url,
    record_type, payload (null for a revisit), payload_bytes, payload_digest,
    refers_to.  An archive or record that breaks the format fails the read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")

    def of(urn):
        found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    def run(batches):
        for b in batches:
            for path, data in zip(b["path"], b["content"]):
                out: dict = {k: [] for k in ("page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to")}
                held = 0
                try:
                    for r in read_archive(data):
                        h = r["headers"]
                        for k, v in (("page_id", of(h["warc-record-id"])), ("url", h.get("warc-target-uri")), ("record_type", r["type"]),
                                     ("payload", r["payload"]), ("payload_bytes", r["length"]), ("payload_digest", r["digest"]),
                                     ("refers_to", of(h.get("warc-refers-to")))):
                            out[k].append(v)
                        held += r["length"]
                        if held > ARCHIVE_BYTES:
                            yield out
                            out, held = {k: [] for k in out}, 0
                except WarcError as e:
                    raise WarcError(f"{path}: {e}") from e
                yield out

    return map_rows(files, run, "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
                                "payload_digest string, refers_to bigint")


def op3_warc_round_trip(spark, sf_dir):
    """Every page written as a WARC record and read back."""
    folder = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
