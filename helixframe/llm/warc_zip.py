"""WARC: archives packaged as ZIP, written and read by ranges.

Each task writes its pages to one ZIP archive in the shared folder: the stored member
``archive/data.warc.gz`` holds one gzip member for each WARC record, the stored member
``indexes/index.cdxj`` one CDXJ line (key, time, JSON with file, offset and length) for each. Nothing
is extracted to read: the central directory (ZIP64 where needed) locates data and indexes, the
indexes locate the records, and neighbouring records are read as one byte range. Archives of other
makers are read as they are found: any number of ``.warc.gz`` and ``.warc`` members, indexes in CDXJ
or bare JSON, plain or gzipped; a data member that no index names is walked once to find its records.
Ranges are dealt to as many tasks as their bytes call for. Archives get names of their own for each
attempt and only those of the tasks that ended well are listed, so a repeated task does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, shared_dir
from .zip_directory import members

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of a range that is read at once, about, and most of its records; records further apart than the gap are other ranges.
RANGE_BYTES = 4 << 20
RANGE_RECORDS = 1024
RANGE_GAP = 1 << 16
#: Bytes that a task reads, about.
TASK_BYTES = 16 << 20
#: Record types that hold a page.
PAGES = ("response", "resource", "revisit")
#: A payload with one part in so many of all rows counts as common.
COMMON = 1000
#: Bytes of an archive, about, and most of its records; a task with more writes several.
ARCHIVE_BYTES = 1 << 30
ARCHIVE_RECORDS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}')}>"


def record(page, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record. A revisit has the payload's length and digest, but not the payload."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page is not None:
        head.append(("X-Page-Id", str(page)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
        block = http + b"\r\n"
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, bytes]:
    """(headers with lower-case names, payload) of a record's bytes: of an HTTP message its body, without chunks, else the block."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower().decode(): v.strip().decode("utf-8", "surrogatepass") for k, v in (x.split(b":", 1) for x in lines)}
    block = rest[: int(fields["content-length"])]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, block
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, _unchunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked", http) else body


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0 and (size := int(body[at:end].split(b";")[0] or b"0", 16)):
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(parts)


def sort_key(url: str | None) -> str:
    """The key of a URL in an index: host names reversed, then the path; "-" without one."""
    if not url:
        return "-"
    scheme, _, rest = url.lower().partition("://")
    host, slash, path = (rest or scheme).partition("/")
    return re.sub(r"\s", "%20", f"{','.join(reversed(host.split('.')))}){slash or '/'}{path}")


class _Archive:
    """A ZIP archive under way; the index is held until it is closed, the records are not."""

    def __init__(self, fs, path: str):
        self.path, self.lines, self.at = path, [], 0
        self.out = fs.open_output_stream(path)
        self.buffer = io.BufferedWriter(_Sink(self.out), 1 << 20)
        self.zip = zipfile.ZipFile(self.buffer, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, url, date: str, kind: str, digest: str, raw: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self.data.write(packed)
        fields = {"url": url or "", "mime": "warc/revisit" if kind == "revisit" else "text/html", "digest": f"sha1:{digest}", "offset": str(self.at), "length": str(len(packed)), "filename": DATA.rsplit("/", 1)[1]}
        self.lines.append(f"{sort_key(url)} {re.sub('[^0-9]', '', date)} {json.dumps(fields)}")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("\n".join(sorted(self.lines)).encode("utf-8", "surrogatepass"))
        self.zip.close()
        self.buffer.flush()
        self.out.close()
        return self.path, len(self.lines), self.at


class _Sink(io.RawIOBase):
    """A stream that can't seek, so that ZIP members are written in one pass."""

    def __init__(self, out):
        self.out = out

    def writable(self):
        return True

    def write(self, data):
        self.out.write(bytes(data))
        return len(data)


def page_roles(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """``pages`` as (page, url, html) with ``first``, the page that a revisit refers to, else null.

    Only ids and digests are dealt out by digest; pages travel by id. Payloads that make up one part
    in COMMON of all rows or more, at most COMMON of them, would meet in one task, so the pages that
    they refer to are broadcast and their rows stay where they are.
    """
    digest = F.sha1(F.coalesce(F.col(html_col), F.lit("")))
    thin = pages.where(F.col(id_col).isNotNull() & (F.octet_length(F.coalesce(html_col, F.lit(""))) >= least_bytes)).select(F.col(id_col).alias("__page"), digest.alias("__digest"))
    thin = materialize(thin)
    firsts = materialize(thin.groupBy("__digest").agg(F.min("__page").alias("first"), F.count("*").alias("rows")).where("rows > 1"))
    common = firsts.where(F.col("rows") * COMMON >= thin.count())
    spread = thin.distinct().join(F.broadcast(common.select("__digest", F.col("first").alias("__common"))), "__digest", "left")
    frequent = spread.where("__common is not null and __page != __common").select("__page", "__digest", F.col("__common").alias("first"))
    rare = spread.where("__common is null").join(firsts.select("__digest", "first"), "__digest").where("__page != first").select("__page", "__digest", "first")
    return pages.join(frequent.unionByName(rare), (F.col(id_col) == F.col("__page")) & (digest == F.col("__digest")), "left")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record for each row of ``pages``; returns (path, n_records, n_bytes) of the archives.

    Of rows with equal payloads of at least ``least_bytes`` bytes, those of the smallest id are
    response records and the others revisit it; smaller payloads are all responses, and so are rows
    with a null id. A null html is an empty payload; a null url is left out. An empty table writes
    no archive.
    """
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    rows = page_roles(pages.select(id_col, url_col, html_col), id_col, html_col, least_bytes).select(F.col(id_col).cast("long"), url_col, html_col, F.col("first").cast("long"))
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        archive, done = None, []
        for batch in batches:
            page_ids, firsts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for i, page in enumerate(page_ids):
                url, html = batch.column(1)[i].as_py(), batch.column(2)[i].as_py() or ""
                if archive is None:
                    archive = _Archive(fs, f"{root}/{uuid.uuid4().hex}.zip")
                payload = html.encode("utf-8", "surrogatepass")
                digest = payload_digest(payload)
                archive.add(url, date, "response" if firsts[i] is None else "revisit", digest, record(page, url, payload, digest, firsts[i], date))
                if archive.at >= archive_bytes or len(archive.lines) >= ARCHIVE_RECORDS:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        named = [(f"{folder}/{path.rsplit('/', 1)[1]}", n, b) for path, n, b in done]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in named], f.type) for i, f in enumerate(schema)], schema=schema)

    return materialize(rows.mapInArrow(run, "path string, n_records long, n_bytes long"))


def index_lines(raw: bytes):
    """(file, offset, length) of the lines of an index in CDXJ or bare JSON; other lines are headers."""
    for line in raw.splitlines():
        at = line.find(b"{")
        if at < 0 or line.startswith(b"!"):
            continue
        fields = json.loads(line[at:])
        if "offset" in fields and "length" in fields:
            yield str(fields.get("filename") or "").rsplit("/", 1)[-1], int(fields["offset"]), int(fields["length"])


def walk_gzip(read, size: int, chunk: int = 1 << 20):
    """(offset, length) of each gzip member of a stored file; ``read(offset, length)`` gives its bytes."""
    at = start = 0
    unpacker, held = zlib.decompressobj(31), b""
    while at < size or held:
        if not held:
            held = read(at, min(chunk, size - at))
            at += len(held)
        unpacker.decompress(held)
        held = unpacker.unused_data
        if unpacker.eof:
            end = at - len(held)
            yield start, end - start
            start, unpacker = end, zlib.decompressobj(31)
    if start < size:
        raise ValueError("the last record is cut off")


def walk_plain(read, size: int):
    """(offset, length) of each record of a stored file that is not compressed."""
    at = 0
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head and at + len(head) < size:
            head += read(at + len(head), min(4096, size - at - len(head)))
        end = head.index(b"\r\n\r\n") + 4
        found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", head[:end])
        length = end + int(found[1]) + 4
        yield at, min(length, size - at)
        at += length


def record_ranges(file) -> list[tuple[int, bool, list[tuple[int, int]]]]:
    """(start in the archive, gzipped, sorted (offset, length) of the records) of each data member of an opened archive."""
    read = lambda at, n: bytes(file.read_at(n, at))
    data, indexed, nameless = {}, {}, []
    for m in members(read, file.size()):
        low = m.name.lower()
        is_index = low.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz"))
        if not is_index and not low.endswith((".warc", ".warc.gz")):
            continue
        if m.method:
            raise ValueError(f"member {m.name} is not stored")
        if is_index:
            raw = read(m.start, m.size)
            for name, offset, length in index_lines(zlib.decompress(raw, 47) if low.endswith(".gz") else raw):
                (indexed.setdefault(name, []) if name else nameless).append((offset, length))
        else:
            data[m.name.rsplit("/", 1)[-1]] = m
    if nameless and len(data) == 1:  # an index of the only file need not name it
        indexed.setdefault(next(iter(data)), []).extend(nameless)
    found = []
    for name, m in data.items():
        gzipped = name.lower().endswith(".gz")
        inner = lambda at, n, m=m: read(m.start + at, n)
        places = indexed.get(name) or list((walk_gzip if gzipped else walk_plain)(inner, m.size))
        found.append((m.start, gzipped, sorted(set(places))))
    return found


def index_parts(archives: DataFrame) -> DataFrame:
    """(path, start, gzipped, first, bytes, offsets, lengths): ranges of neighbouring records, of bounded bytes."""
    names = ["path", "start", "gzipped", "first", "bytes", "offsets", "lengths"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _opened(path) as file:
                    found = record_ranges(file)
                rows = []
                for start, gzipped, places in found:
                    part: list[tuple[int, int]] = []
                    for offset, length in [*places, (None, None)]:
                        end = sum(part[-1]) if part else 0
                        full = part and (offset is None or len(part) >= RANGE_RECORDS or offset + length - part[0][0] > RANGE_BYTES or offset > end + RANGE_GAP)
                        if full:
                            rows.append((path, start, gzipped, part[0][0], max(map(sum, part)) - part[0][0], [o for o, _ in part], [n for _, n in part]))
                            part = []
                        part.append((offset, length))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    paths = archives.select("path")
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(run, "path string, start long, gzipped boolean, first long, bytes long, offsets array<long>, lengths array<long>")


def _opened(path: str):
    fs, inner = pyarrow.fs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, record_id string, refers_to_id string, payload binary"


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The page records of the archives, a table with their paths: (page_id, url, record_type, payload_bytes, payload_digest, refers_to, record_id, refers_to_id, payload).

    Record types are response, resource and revisit; others, such as requests, are left out. Lengths
    and digests of responses are taken from the payloads that were read and must agree with the
    records' own SHA-1 digest where they have one; those of revisits are the records'. Page ids are
    known of archives that ``write_archives`` wrote, record ids of all. Null paths are no archives;
    paths that are listed twice are read twice; archives without records and an empty table give no
    rows; other columns are ignored. Payloads of any length are read whole.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def page(raw: bytes, gzipped: bool, path: str):
        fields, body = parse_record(zlib.decompress(raw, 31) if gzipped else raw)
        kind = fields.get("warc-type")
        if kind not in PAGES:
            return None
        scheme, _, own = fields.get("warc-payload-digest", "").rpartition(":")
        number = lambda name: int(fields[name]) if name in fields else None
        if kind == "revisit":
            size, digest, body = number("x-payload-length"), own or None, None
        else:
            size, digest = len(body), payload_digest(body)
            if own and scheme.lower() in ("", "sha1") and own.upper() != digest:
                raise ValueError(f"a record of {path} doesn't match its digest")
        return number("x-page-id"), fields.get("warc-target-uri"), kind, size, digest, number("x-refers-to-page-id"), fields.get("warc-record-id"), fields.get("warc-refers-to"), body if with_payload else None

    def run(batches):
        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        for batch in batches:
            for path, start, gzipped, first, size, offsets, lengths in zip(*(batch.column(i).to_pylist() for i in range(7))):
                with _opened(path) as file:
                    raw = bytes(file.read_at(size, start + first))
                rows, held = [], 0
                for at, n in zip(offsets, lengths):
                    found = page(raw[at - first : at - first + n], gzipped, path)
                    if found:
                        rows.append(found)
                        held += len(found[-1] or b"")
                    if held > 1 << 24:
                        yield made(rows)
                        rows, held = [], 0
                yield made(rows)

    parts = materialize(index_parts(archives.where("path is not null")))
    size = parts.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("parts")).first()
    # An explicit number: of the rows' own bytes Spark would make one task.
    tasks = max(1, min(size["parts"], max(-(-size["bytes"] // TASK_BYTES), archives.sparkSession.sparkContext.defaultParallelism)))
    return parts.repartition(tasks, "path", "start", "first").mapInArrow(run, RECORD)


def archive_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the ZIP archives of a folder, listed by Spark."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path")
