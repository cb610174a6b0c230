"""Media columns in Ogg: multiplexing and demultiplexing of logical bitstreams (RFC 3533).

``mux`` writes pages, ``demux`` reads them: it verifies each page's checksum and sequence number, reassembles
packets from the lacing values (packets may continue over pages), separates logical streams by serial number
and derives times from granule positions. ``text_media`` stores texts as 8-bit samples in such a file.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, read_table, text_or_empty

FRAME = 576
RATE = 8000
_HEAD = struct.Struct("<4sBBqIIIB")
_FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_CONTINUED, _FIRST, _LAST = 1, 2, 4
_DATA_MAGIC, _NOTE_MAGIC = b"\x01pcm8u\x00", b"\x01notes\x00"


class OggError(ValueError):
    """A damaged or incomplete bitstream."""


def page_crc(data: bytes) -> int:
    """Ogg's CRC-32: polynomial 04c11db7, not reflected, from 0. zlib's is the reflected one, so bits are reversed around it."""
    raw = zlib.crc32(data.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(raw.to_bytes(4, "little").translate(_FLIP), "big")


def _page(serial: int, number: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    blank = _HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing + body
    return blank[:22] + page_crc(blank).to_bytes(4, "little") + blank[26:]


def stream_pages(serial: int, packets: list[bytes], granules: list[int]) -> Iterator[bytes]:
    """The pages of one logical stream. ``granules[i]`` is the position after packet i; the first packet has a page of its own."""
    number, flags, lacing, body, granule = 0, _FIRST, bytearray(), bytearray(), -1
    last = len(packets) - 1
    for i, packet in enumerate(packets):
        at, left = 0, len(packet)
        while True:
            n = min(255, left)
            lacing.append(n)
            body += packet[at : at + n]
            at, left = at + n, left - n
            done = n < 255
            if done:
                granule = granules[i]
            end = done and i == last
            if len(lacing) == 255 or end or (done and i == 0):
                yield _page(serial, number, flags | (_LAST if end else 0), granule, bytes(lacing), bytes(body))
                number, flags, granule = number + 1, 0 if done else _CONTINUED, -1
                lacing.clear()
                body.clear()
            if done:
                break


def mux(streams: list[tuple[int, list[bytes], list[int]]]) -> bytes:
    """One physical bitstream: every stream's first page, then the other pages in turn."""
    pages = [list(stream_pages(*s)) for s in streams]
    out = [p[0] for p in pages if p]
    rest = [p[1:] for p in pages]
    for i in range(max((len(p) for p in rest), default=0)):
        out += [p[i] for p in rest if i < len(p)]
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    ended: bool = False
    _next: int = 0
    _part: list[bytes] | None = None

    def times(self, rate: int) -> list[float | None]:
        """Seconds at the end of each packet; None where no packet boundary on the page fixes one."""
        return [None if g < 0 else g / rate for g in self.granules]


def demux(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number. Raises OggError for a bad checksum, a lost page or a packet that does not end."""
    streams: dict[int, Stream] = {}
    at, size = 0, len(data)
    while at < size:
        if size - at < 27 or data[at : at + 4] != b"OggS":
            raise OggError(f"no page at byte {at}")
        _, version, flags, granule, serial, number, crc, segments = _HEAD.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + segments]
        start = at + 27 + segments
        end = start + sum(lacing)
        if version or len(lacing) < segments or end > size:
            raise OggError(f"cut page at byte {at}")
        if page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"bad checksum at byte {at}")
        if flags & _FIRST:
            if serial in streams:
                raise OggError(f"stream {serial} begins twice")
            streams[serial] = Stream(serial)
        s = streams.get(serial)
        if s is None or number != s._next or s.ended or bool(flags & _CONTINUED) != (s._part is not None):
            raise OggError(f"page {number} of stream {serial} is out of sequence")
        s._next += 1
        pos, run, finished = start, 0, 0
        for n in lacing:
            run += n
            if n < 255:
                piece = data[pos : pos + run]
                s.packets.append(b"".join([*s._part, piece]) if s._part else piece)
                s.granules.append(-1)
                s._part, pos, run, finished = None, pos + run, 0, finished + 1
        if lacing and lacing[-1] == 255:
            s._part = [*(s._part or []), data[pos : pos + run]]
        if finished:
            s.granules[-1] = granule
        s.ended = bool(flags & _LAST)
        at = end
    for s in streams.values():
        if s._part is not None or not s.ended:
            raise OggError(f"stream {s.serial} does not end")
    return streams


def spread_granules(granules: list[int], step: int) -> list[int]:
    """Fills positions of packets inside a page backwards from the page's own, for packets of ``step`` units."""
    out, after = list(granules), None
    for i in range(len(out) - 1, -1, -1):
        if out[i] < 0 and after is not None:
            out[i] = after - step
        after = out[i] if out[i] >= 0 else None
    return out


def encode_payload(raw: bytes) -> bytes:
    """``raw`` padded with bytes 255 to a positive multiple of 576, as one packet a frame, beside a stream that notes the unpadded length."""
    payload = raw + b"\xff" * ((-len(raw)) % FRAME or (FRAME if not raw else 0))
    serial = zlib.crc32(payload)
    frames = len(payload) // FRAME
    data = [_DATA_MAGIC + struct.pack("<IH", RATE, FRAME), *(payload[i * FRAME : (i + 1) * FRAME] for i in range(frames))]
    notes = [_NOTE_MAGIC, struct.pack("<Q", len(raw))]
    return mux([(serial, data, [0, *range(FRAME, (frames + 1) * FRAME, FRAME)]), (serial ^ 0xFFFFFFFF, notes, [0, len(payload)])])


def decode_payload(media: bytes) -> tuple[bytes, int, float]:
    """(padded payload, unpadded length, seconds by the last granule position)."""
    payload, length, seconds = b"", 0, 0.0
    for s in demux(media).values():
        if s.packets and s.packets[0].startswith(_DATA_MAGIC):
            rate, frame = struct.unpack_from("<IH", s.packets[0], len(_DATA_MAGIC))
            payload = b"".join(s.packets[1:])
            last = spread_granules(s.granules, frame)[-1]
            if last != len(payload):
                raise OggError("granule positions do not agree with the samples")
            seconds = last / rate
        elif s.packets and s.packets[0].startswith(_NOTE_MAGIC):
            (length,) = struct.unpack("<Q", s.packets[1])
    return payload, length, seconds


def sample_features(payload: bytes, seconds: float) -> str:
    """Duration, level, spread, peak, crossings of the mean level and an 8-bin histogram of unsigned 8-bit samples."""
    x = np.frombuffer(payload, dtype=np.uint8)
    hist = np.bincount(x >> 5, minlength=8)
    mean = float(x.mean())
    above = x > 128
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    return f"sec={seconds:.4f};mean={mean:.4f};std={float(x.std()):.4f};peak={int(x.max())};cross={crossings};hist=" + ",".join(map(str, hist.tolist()))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def _store_and_read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in _OUT]
        ids = batch.column(0)
        step = 256
        for lo in range(0, batch.num_rows, step):
            for raw in batch.column(1).slice(lo, step).cast(pa.binary()).to_pylist():
                media = encode_payload(raw)
                payload, n, seconds = decode_payload(media)
                row = (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), sample_features(payload, seconds))
                for c, v in zip(cols[1:], row, strict=True):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(cols[1:], _OUT.types[1:], strict=True))], schema=_OUT)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as an Ogg file, reads it back and returns sizes, digests and features, one row per row.

    Null and empty texts are one frame of padding. Repeated rows and null ids stay as they are. Other columns
    are not read, so their names cannot clash. No shuffle: rows are handled where they are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ddl = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(lean(_store_and_read), ddl)


def op10_ogg_media(spark, sf_dir: str) -> DataFrame:
    return text_media(read_table(spark, sf_dir, "documents"))
