"""WARC records in ZIP packages, read by byte ranges.

The writer packs gzip-compressed WARC records into a stored member ``archive/data.warc.gz`` beside a stored index of
their offsets. The reader parses the end record, the ZIP64 locator and directory where there are any, and the central
directory; finds where each stored member's bytes begin; reads the index; and then range-reads runs of records. No member
is extracted and no archive is read as a whole. Archives are files in the shared folder, reached by its own file system.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, lean, read_table, scratch_dir, stored, text_or_empty

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Payloads under this size are never revisits.
LEAST = 100
#: An archive is closed at about this many bytes; readers take runs of about RUN bytes.
ARCHIVE, RUN = 16 << 20, 2 << 20
#: The most that a reading task gets on average.
READ_BYTES = 128 << 20
_BIG32, _BIG16 = 0xFFFFFFFF, 0xFFFF


class ZipError(ValueError):
    """Not a readable ZIP package."""


# --- ZIP


def write_zip(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A package of stored members; with ZIP64 fields where sizes need them or ``zip64`` is set."""
    out, central = io.BytesIO(), io.BytesIO()
    for name, body in members:
        raw, at, crc, n = name.encode(), out.tell(), zlib.crc32(body), len(body)
        wide = zip64 or n >= _BIG32 or at >= _BIG32
        extra = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
        size = _BIG32 if wide else n
        out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if wide else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra)) + raw + extra + body)
        extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if wide else b""
        central.write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if wide else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, _BIG32 if wide else at) + raw + extra)
    start, size, count = out.tell(), central.tell(), len(members)
    out.write(central.getvalue())
    wide = zip64 or count >= _BIG16 or start >= _BIG32
    if wide:
        end = out.tell()
        out.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, size, start) + struct.pack("<IIQI", 0x07064B50, 0, end, 1))
    out.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, _BIG16 if wide else count, _BIG16 if wide else count, _BIG32 if wide else size, _BIG32 if wide else start, 0))
    return out.getvalue()


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def directory(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """Members by the central directory; ``read(offset, n)`` gives a range of the package of ``size`` bytes."""
    tail_at = max(0, size - 22 - _BIG16)
    tail = read(tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ZipError("no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == _BIG16 or length == _BIG32 or start == _BIG32:
        where = tail_at + at - 20
        locator = read(where, 20) if where >= 0 else b""
        if locator[:4] != b"PK\x06\x07":
            raise ZipError("no ZIP64 locator")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ZipError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    raw = read(start, length)
    if len(raw) < length:
        raise ZipError("cut central directory")
    out, pos = [], 0
    for _ in range(count):
        if raw[pos : pos + 4] != b"PK\x01\x02":
            raise ZipError("bad central directory entry")
        method, crc, packed, plain, n, m, k, header = struct.unpack_from("<H4xIIIHHH8xI", raw, pos + 10)
        name, extra = raw[pos + 46 : pos + 46 + n], raw[pos + 46 + n : pos + 46 + n + m]
        x = 0
        while x + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, x)
            if tag == 1:
                wide = [*struct.unpack_from(f"<{width // 8}Q", extra, x + 4)]
                plain = wide.pop(0) if plain == _BIG32 else plain
                packed = wide.pop(0) if packed == _BIG32 else packed
                header = wide.pop(0) if header == _BIG32 else header
            x += 4 + width
        out.append(Member(name.decode("utf-8", "replace"), method, crc, packed, plain, header))
        pos += 46 + n + m + k
    return out


def member_start(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a stored member's bytes begin: its local header has name and extra lengths of its own."""
    if member.method != 0:
        raise ZipError(f"{member.name} is compressed as a member; ranges of it can't be read")
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ZipError(f"no local header of {member.name}")
    n, m = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + m


# --- WARC


def record(rec_type: str, page: str, url: str, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record, compressed by itself. A revisit has the HTTP header only, with the ``size`` of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if rec_type == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {rec_type}",
        f"WARC-Record-ID: <urn:page:{page}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if rec_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def read_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of the record in one gzip member."""
    z = zlib.decompressobj(31)
    try:
        plain = z.decompress(raw)
    except zlib.error as e:
        raise ZipError(f"damaged record: {e}") from None
    if not z.eof or z.unused_data:
        raise ZipError("a record does not end where the index says")
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ZipError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) != n + 4:
        raise ZipError("bad record length")
    return fields, rest[:n]


def _page_of(urn: str | None) -> int | None:
    value = urn.rpartition(":")[2].rstrip(">") if urn else "none"
    return None if value == "none" else int(value)


# --- files in the shared folder


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def _writer(folder: str, limit: int, zip64: bool):
    schema = pa.schema([("path", pa.string()), ("n", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(folder)
        task = TaskContext.get()
        # Another attempt of the task writes other files; only what this one reports is read.
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        data, index, made = io.BytesIO(), [], 0

        def close() -> pa.RecordBatch:
            nonlocal data, index, made
            name = f"{stem}-{made:05d}.wacz"
            body = write_zip([(DATA, data.getvalue()), (INDEX, "".join(index).encode())], zip64)
            fs.create_dir(base, recursive=True)
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(body)
            out = pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n": [len(index)], "bytes": [len(body)]}, schema=schema)
            data, index, made = io.BytesIO(), [], made + 1
            return out

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for r in batch.slice(lo, 64).to_pylist():
                    page = "none" if r["page_id"] is None else str(r["page_id"])
                    refers = None if r["refers_to"] is None else str(r["refers_to"])
                    body = record(r["record_type"], page, r["url"], r["digest"], r["size"], (r["payload"] or "").encode("utf-8", "replace"), refers)
                    index.append(f"{data.tell()} {len(body)} {page}\n")
                    data.write(body)
                    if data.tell() >= limit:
                        yield close()
        if index:
            yield close()

    return run


_RUNS = pa.schema([("path", pa.string()), ("at", pa.int64()), ("lengths", pa.list_(pa.int64())), ("pages", pa.list_(pa.int64())), ("problem", pa.string())])


def _index_of(path: str) -> tuple[int, list[tuple[int, int, int | None]]]:
    """Where the data member of an archive begins, and (offset in it, length, page) of its records."""
    fs, name = _open_fs(path)
    with fs.open_input_file(name) as f:
        read = lambda at, n: f.read_at(n, at)
        members = {m.name: m for m in directory(read, f.size())}
        if DATA not in members or INDEX not in members:
            raise ZipError("no data or no index")
        start, index = member_start(read, members[DATA]), members[INDEX]
        raw = read(member_start(read, index), index.size)
    if zlib.crc32(raw) != index.crc:
        raise ZipError("bad checksum of the index")
    lines = [line.split() for line in raw.decode().splitlines()]
    return start, [(int(at), int(n), None if page == "none" else int(page)) for at, n, page in lines]


def _locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From archives, runs of records: path, offset, and the length and page of each; of an unreadable archive what is wrong."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            runs: list[tuple[int, list, list]] = []
            problem = None
            try:
                start, records = _index_of(path)
                held = RUN
                for at, n, page in records:
                    if held >= RUN or runs[-1][0] + sum(runs[-1][1]) != start + at:
                        runs.append((start + at, [], []))
                        held = 0
                    runs[-1][1].append(n)
                    runs[-1][2].append(page)
                    held += n
            except (ZipError, OSError, ValueError, struct.error) as e:
                runs, problem = [(0, [], [])], f"{path.rpartition('/')[2]}: {e}"
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([path] * len(runs), *map(list, zip(*runs)), [problem] * len(runs)) if runs else [[]] * 5, _RUNS.types, strict=True)], schema=_RUNS)


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("problem", pa.string()), ("payload", pa.binary())])


def _row_of(raw: bytes) -> tuple:
    fields, block = read_record(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).partition(b":")[2])
    digest = fields["warc-payload-digest"].partition(":")[2]
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ZipError("a payload does not have its digest")
    return _page_of(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, fields["warc-type"], _page_of(fields.get("warc-refers-to")), None, payload


def _range_read(payloads: bool):
    schema = _READ if payloads else pa.schema(list(_READ)[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows: list[list] = [[] for _ in schema]

                def put(row: tuple, rows=rows) -> None:
                    for c, v in zip(rows, row, strict=False):
                        c.append(v)

                if r["problem"]:
                    put((None, None, None, None, None, None, r["problem"], None))
                else:
                    fs, name = _open_fs(r["path"])
                    with fs.open_input_file(name) as f:
                        raw = memoryview(f.read_at(sum(r["lengths"]), r["at"]))
                    at = 0
                    for n, page in zip(r["lengths"], r["pages"], strict=True):
                        try:
                            put(_row_of(bytes(raw[at : at + n])))
                        except (ZipError, ValueError, KeyError, StopIteration) as e:
                            put((page, None, None, None, None, None, f"{name.rpartition('/')[2]} at {r['at'] + at}: {e}", None))
                        at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    return run


# --- operators


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """page_id, url, payload (null for revisits), size, digest, record_type, refers_to of every row.

    Of rows with equal payloads of LEAST bytes or more, that with the least page_id is the response and others revisit it;
    rows that repeat that id and payload are responses too. A null id is never the least, unless all are null: then all are
    responses. Null payloads and urls count as empty.
    """
    payload = text_or_empty(text_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), text_or_empty(url_col).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"))
    least = rows.filter(F.col("size") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1 and least is not null")
    # Fewer than HOT payloads have more rows than this: they are told by broadcast, and their revisits leave the payload behind.
    limit = max(100, pages.count() // HOT)
    hot = F.broadcast(least.filter(F.col("n") > limit).drop("n"))
    frequent = rows.join(hot, "digest")
    others = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(least.filter(F.col("n") <= limit).drop("n"), "digest", "left")
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return frequent.unionByName(others).select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "size", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("least")).alias("refers_to"))


def write_archives(plan: DataFrame, folder: str, limit: int = ARCHIVE, zip64: bool = False) -> DataFrame:
    """Writes packages of about ``limit`` bytes to ``folder`` and returns the list of them (path, n, bytes)."""
    return stored(plan.mapInArrow(lean(_writer(folder, limit, zip64)), "path string, n long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the packages named in ``manifest`` (path, bytes): page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, problem, and the payload of responses if asked for.

    ``problem`` is null for a sound record. A damaged record has its page_id and the problem only; a package that can't be
    read has one row with the problem only. Runs of records are dealt to tasks evenly: at most one a run, else four a core
    or one for READ_BYTES.
    """
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    total = manifest.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    finders = max(1, min(total["n"], max(4 * cores, total["n"] // 64)))
    readers = max(1, min(-(-total["bytes"] // RUN), max(4 * cores, total["bytes"] // READ_BYTES)))
    runs = manifest.select("path").repartition(finders).mapInArrow(_locate, "path string, at long, lengths array<long>, pages array<long>, problem string")
    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string" + ", payload binary" * payloads
    return runs.repartition(readers).mapInArrow(lean(_range_read(payloads)), ddl)


def op4_warc_zip(spark, sf_dir: str) -> DataFrame:
    manifest = write_archives(plan_records(read_table(spark, sf_dir, "pages")), scratch_dir(spark, "warc"))
    read = read_archives(manifest)
    # What was just written must be sound.
    return read.withColumn("payload_digest", F.when(F.col("problem").isNull(), F.col("payload_digest")).otherwise(F.raise_error("problem"))).drop("url", "problem")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, octet_length(encode(t)) AS n, sha256(t) AS h FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS least FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND least IS NOT NULL AND page_id IS DISTINCT FROM least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND least IS NOT NULL AND page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM m
"""
