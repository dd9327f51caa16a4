"""Media columns: AVI files of motion JPEG, written from bytes, indexed, decoded frame by frame and cut into clips.

Bytes are grey samples of 32 x 18 frames. Each frame is an intra-coded JPEG of the lossless process (SOF3, 8-bit samples,
predictor 1), so stored bytes come back as they were. A reader parses the RIFF index, decodes the frames (those of our own
form many in step, one sample of each at a time; those of the baseline process, which cameras write, one by one, their
brightness), takes a histogram of each, and starts a new shot where the histogram differs from the last one by more than
an adaptive bound: the mean and spread of the differences just before.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.tables import bound_batches

WIDTH, HEIGHT, FPS = 32, 18, 25
SAMPLES = WIDTH * HEIGHT
BINS = 16
#: Shots: differences looked back on, spreads above their mean, least difference, least frames in a shot.
BACK, SPREADS, LEAST, SHORTEST = 8, 2.0, 0.08, 2
#: Frames coded or decoded together.
TOGETHER = 2048

# The entropy code of our writer: categories 0 .. 8 of a difference, each of 4 bits, then the category's bits.
_d = np.arange(-255, 256)
_cat = np.array([int(abs(d)).bit_length() for d in _d])
_value = (_cat << _cat | np.where(_d >= 0, _d, _d + (1 << _cat) - 1)).astype(np.uint16)
_width = (4 + _cat).astype(np.uint8)
_huffman = bytes([0, 0, 0, 9, *[0] * 12, *range(9)])
_HEADER = (
    b"\xff\xd8"
    + b"\xff\xc3" + struct.pack(">HBHHB3B", 11, 8, HEIGHT, WIDTH, 1, 1, 0x11, 0)
    + b"\xff\xc4" + struct.pack(">HB", 3 + len(_huffman), 0) + _huffman
    + b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0, 1, 0, 0)
)


def payload(text: str | None) -> bytes:
    """UTF-8 bytes, then bytes 255 (never part of UTF-8) up to a positive multiple of a frame."""
    data = (text or "").encode()
    return data + b"\xff" * (max(1, -(-len(data) // SAMPLES)) * SAMPLES - len(data))


def _scans(samples: np.ndarray) -> list[bytes]:
    """The entropy-coded segment of each frame; samples: frames x SAMPLES."""
    n = len(samples)
    x = samples.reshape(n, HEIGHT, WIDTH).astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    d = d.reshape(n, SAMPLES) + 255
    value, width = np.empty((n, SAMPLES + 1), np.uint16), np.empty((n, SAMPLES + 1), np.uint8)
    value[:, :-1], width[:, :-1] = _value[d], _width[d]
    bits = width[:, :-1].sum(1, dtype=np.int64)
    value[:, -1], width[:, -1] = 0x7FF, -bits % 8  # ones up to a whole byte
    at = np.arange(11, -1, -1, dtype=np.uint16)
    flags = (value[..., None] >> at & 1).astype(np.uint8)[width[..., None] > at]
    packed = np.packbits(flags).tobytes()
    ends = np.cumsum((bits + 7) // 8).tolist()
    return [packed[a:b].replace(b"\xff", b"\xff\x00") for a, b in zip([0, *ends], ends, strict=False)]


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    """An AVI file of JPEG frames with an idx1 index."""
    largest = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", SAMPLES, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    body, index, at = [], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        body.append(c)
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        at += len(c)
    rest = b"AVI " + header + _chunk(b"LIST", b"movi" + b"".join(body)) + _chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(rest)) + rest


def encode_all(payloads: list[bytes]) -> list[bytes]:
    """An AVI file for each payload; frames of several payloads are coded together."""
    whole = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, SAMPLES)
    scans = [s for i in range(0, len(whole), TOGETHER // 2) for s in _scans(whole[i : i + TOGETHER // 2])]
    frames = [_HEADER + s + b"\xff\xd9" for s in scans]
    ends = np.cumsum([len(p) // SAMPLES for p in payloads]).tolist()
    return [write_avi(frames[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def index(media: bytes) -> tuple[list[tuple[int, int]], float]:
    """Place and length of each video frame from the RIFF index, and frames a second."""
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    movi, fps, entries = 0, float(FPS), None
    todo = [(12, min(len(media), 8 + struct.unpack_from("<I", media, 4)[0]))]
    while todo:
        at, end = todo.pop()
        while at + 8 <= end:
            name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
            if name == b"LIST":
                kind = media[at + 8 : at + 12]
                if kind == b"movi":
                    movi = at + 8
                else:
                    todo.append((at + 12, at + 8 + size))
            elif name == b"strh" and media[at + 8 : at + 12] == b"vids":
                scale, rate = struct.unpack_from("<II", media, at + 8 + 20)
                fps = rate / scale
            elif name == b"idx1":
                entries = np.frombuffer(media, "<u4", size // 4, at + 8).reshape(-1, 4)
            at += 8 + size + (size & 1)
    if fps <= 0 or entries is None or not movi:
        raise ValueError("no index")
    video = np.frombuffer(b"dc", "<u2")[0]
    own = entries[(entries[:, 0] >> 16) == video]
    base = movi if not len(own) or media[movi + own[0, 2] : movi + own[0, 2] + 4] == own[0, :1].tobytes() else 0
    return [(base + int(o) + 8, int(n)) for o, n in own[:, 2:].tolist()], fps


def _codes(counts: bytes, symbols: bytes) -> np.ndarray:
    """(symbol, length) for each 16 bits ahead, of a canonical code: counts of the lengths 1 .. 16 and the symbols."""
    table, code, at = np.zeros((1 << 16, 2), np.int64), 0, 0
    for k in range(16):
        for _ in range(counts[k]):
            first = code << (15 - k)
            table[first : first + (1 << (15 - k))] = symbols[at], k + 1
            code, at = code + 1, at + 1
        code <<= 1
    return table


@dataclass
class Header:
    """What a frame's segments say before its scan."""

    process: int = 0  # SOF0 baseline, SOF3 lossless
    size: tuple[int, int] = (0, 0)
    sampling: tuple[tuple[int, int, int, int], ...] = ()  # component, across, down, quantisation
    predictor: int = 0
    restart: int = 0
    scan: tuple[tuple[int, int, int], ...] = ()  # component, DC table, AC table
    tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    quant: dict[int, np.ndarray] = field(default_factory=dict)


def _parse(frame: bytes, known: dict[bytes, Header]) -> tuple[int, Header]:
    """Where the scan begins, and the header; headers seen before are remembered. Anything but a grey or colour frame of 8
    bits, baseline or lossless with predictor 1, raises ValueError."""
    for head, what in known.items():
        if frame.startswith(head):
            return len(head), what
    if frame[:2] != b"\xff\xd8":
        raise ValueError("no JPEG frame")
    h, at = Header(), 2
    while at + 4 <= len(frame):
        if frame[at] != 0xFF:
            raise ValueError("no JPEG segment")
        mark, length = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        seg = frame[at + 4 : at + 2 + length]
        if mark in (0xC0, 0xC1, 0xC3):
            bits, height, width, n = struct.unpack_from(">BHHB", seg)
            if bits != 8 or (mark == 0xC3 and n != 1):
                raise ValueError("only frames of 8 bits, lossless ones of one component")
            h.process, h.size = mark, (height, width)
            h.sampling = tuple((seg[6 + 3 * i], seg[7 + 3 * i] >> 4, seg[7 + 3 * i] & 15, seg[8 + 3 * i]) for i in range(n))
        elif 0xC2 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            raise ValueError("neither baseline nor lossless")
        elif mark == 0xC4:
            while seg:
                n = sum(seg[1:17])
                h.tables[seg[0] >> 4, seg[0] & 15] = _codes(seg[1:17], seg[17 : 17 + n])
                seg = seg[17 + n :]
        elif mark == 0xDB:
            while seg:
                wide = seg[0] >> 4
                h.quant[seg[0] & 15] = np.frombuffer(seg, ">u2" if wide else "u1", 64, 1).astype(np.int64)
                seg = seg[1 + 64 * (1 + wide) :]
        elif mark == 0xDD:
            h.restart = struct.unpack(">H", seg)[0]
        elif mark == 0xDA:
            h.scan = tuple((seg[1 + 2 * i], seg[2 + 2 * i] >> 4, seg[2 + 2 * i] & 15) for i in range(seg[0]))
            h.predictor = seg[1 + 2 * seg[0]]
            if h.process == 0xC3 and (h.predictor != 1 or (0, h.scan[0][1]) not in h.tables):
                raise ValueError("only predictor 1, with its table")
            if not h.process or not h.size[0] * h.size[1]:
                raise ValueError("no size")
            known[frame[: at + 2 + length]] = h
            return at + 2 + length, h
        at += 2 + length
    raise ValueError("no scan")


_k = np.arange(8)
_COSINES = np.where(_k == 0, np.sqrt(1 / 8), 0.5)[:, None] * np.cos((2 * _k[None, :] + 1) * _k[:, None] * np.pi / 16)
#: The zigzag order of an 8 x 8 block: by diagonals, every other one upwards.
_ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8) if (i // 8 + i % 8) % 2 else i % 8)))


def decode_baseline(scan: bytes, h: Header) -> np.ndarray:
    """The brightness (first component) of a baseline frame, as samples of its height and width, row by row."""
    parts = re.split(rb"\xff[\xd0-\xd7]", scan) if h.restart else [scan]
    sampling = {c: (x, y, q) for c, x, y, q in h.sampling}
    most_x, most_y = max(x for x, _, _ in sampling.values()), max(y for _, y, _ in sampling.values())
    alone = len(h.scan) == 1
    wide, high = -(-h.size[1] // (8 * (1 if alone else most_x))), -(-h.size[0] // (8 * (1 if alone else most_y)))
    first = h.scan[0][0]
    x0, y0, q0 = sampling[first]
    across, down = (1, 1) if alone else (x0, y0)
    if not alone and (x0, y0) != (most_x, most_y):
        raise ValueError("brightness is sampled less than colour")
    blocks = np.zeros((high * down, wide * across, 64))
    units = wide * high
    for p, part in enumerate(parts):
        data = part.replace(b"\xff\x00", b"\xff") + b"\xff" * 4
        pos, last = 0, dict.fromkeys(sampling, 0)

        def ahead(n: int) -> int:
            at = pos >> 3
            return int.from_bytes(data[at : at + 4], "big") >> (32 - n - (pos & 7)) & ((1 << n) - 1)

        for unit in range(p * h.restart, min(units, (p + 1) * h.restart) if h.restart else units):
            for c, dc, ac in h.scan:
                cx, cy = (1, 1) if alone else sampling[c][:2]
                for b in range(cx * cy):
                    block, k = [0] * 64, 0
                    while k < 64:
                        symbol, n = h.tables[(0, dc) if k == 0 else (1, ac)][ahead(16)].tolist()
                        if not n or pos >= 8 * len(data):
                            raise ValueError("broken scan")
                        pos += n
                        run, size = (0, symbol) if k == 0 else (symbol >> 4, symbol & 15)
                        if k and not size and run != 15:
                            break
                        k += run
                        value = 0
                        if size:
                            value = ahead(size)
                            pos += size
                            value -= 0 if value >> (size - 1) else (1 << size) - 1
                        if k == 0:
                            last[c] = value = last[c] + value
                        if k > 63:
                            raise ValueError("broken block")
                        block[k] = value
                        k += 1
                    if c == first:
                        blocks[unit // wide * cy + b // cx, unit % wide * cx + b % cx] = block
    natural = np.empty_like(blocks)
    natural[..., _ZIGZAG] = blocks * h.quant[q0]
    shown = _COSINES.T @ natural.reshape(*blocks.shape[:2], 8, 8) @ _COSINES + 128
    rows = np.clip(np.round(shown), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(blocks.shape[0] * 8, -1)
    return rows[: h.size[0], : h.size[1]].ravel()


def decode_lossless(scans: list[bytes], h: Header) -> np.ndarray:
    """Samples of frames that have the same header: frames x (height * width), uint8."""
    (height, width), table = h.size, h.tables[0, h.scan[0][1]][::256]
    scans = [x.replace(b"\xff\x00", b"\xff") for x in scans]
    starts = np.cumsum([0, *map(len, scans)])[:-1].astype(np.int64)
    raw = np.frombuffer(b"".join(scans) + b"\xff" * 8, np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # 32 bits from each byte on
    category, length = table[:, 0].astype(np.uint32), table[:, 1].astype(np.uint32)
    pos = starts.astype(np.uint32) * 8 if len(raw) < 1 << 28 else starts * 8
    n = len(scans)
    out = np.empty((height * width, n), np.uint8)
    x, first, one = np.full(n, 128, np.int32), np.full(n, 128, np.int32), np.uint32(1)
    for i in range(height * width):
        w = ahead[pos >> 3] << (pos & 7).astype(np.uint32)
        code = w >> 24
        c, k = category[code], length[code]
        v = ((w << k) >> np.uint32(1) >> (np.uint32(31) - c)).astype(np.int32)
        full = (one << c).astype(np.int32)
        v -= np.where(v < full >> 1, full - 1, 0)
        x = (first if i % width == 0 else x) + v
        if i % width == 0:
            first = x
        out[i] = x
        pos = pos + k + c
    return np.ascontiguousarray(out.T)


def histograms(samples: np.ndarray) -> np.ndarray:
    n = len(samples)
    if not samples.size:
        return np.zeros((n, BINS))
    at = (np.arange(n) * BINS)[:, None] + (samples >> 4)
    return np.bincount(at.ravel(), minlength=n * BINS).reshape(n, BINS) / samples.shape[1]


def shots(hist: np.ndarray) -> list[tuple[int, int, float]]:
    """(first frame, frames, difference at its start) of each shot."""
    diff = [0.0, *(np.abs(np.diff(hist, axis=0)).sum(1) / 2).tolist()]
    found, start = [], 0
    for i in range(1, len(diff)):
        back = diff[max(start + 1, i - BACK) : i]
        mean = sum(back) / len(back) if back else LEAST
        spread = (sum((b - mean) ** 2 for b in back) / len(back)) ** 0.5 if back else LEAST
        if i - start >= SHORTEST and diff[i] > max(LEAST, mean + SPREADS * spread):
            found.append((start, i - start, diff[start]))
            start = i
    return [*found, (start, len(diff) - start, diff[start])]


CLIPS = T.ArrayType(T.StructType([T.StructField("first_frame", T.IntegerType()), T.StructField("frames", T.IntegerType()), T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType()), T.StructField("change", T.DoubleType())]))


def _parts(batch: pa.RecordBatch, column: int, size) -> Iterator[tuple[int, list]]:
    """The values of a column in lists of about TOGETHER frames, each with the place of its first value."""
    part, first, held = [], 0, 0
    for i, v in enumerate(batch.column(column)):
        part.append(v.as_py())
        held += size(part[-1])
        if held >= TOGETHER * SAMPLES:
            yield first, part
            part, first, held = [], i + 1, 0
    if part:
        yield first, part


def store(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes (of the text), media: an AVI file that holds each whole text (null: empty). Equal texts give equal
    files; repeated rows and null keys are rows like any other; other columns aren't read; an empty table gives an empty
    result."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _parts(batch, 1, lambda t: len(t or "")):
                data = [payload(t) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(encode_all(data), pa.binary())], ["k", "n_bytes", "media"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema).withColumnRenamed("k", key)


def read_media(media: list[bytes]) -> list[tuple[np.ndarray, float] | str]:
    """(frames x samples, frames a second) of each file, or what is wrong with it. Lossless frames of one form are decoded
    together, of whichever files they are; a file that can't be decoded with others is tried alone."""
    out: list = [None] * len(media)
    known: dict[bytes, Header] = {}
    lossless: dict[int, tuple[Header, list[tuple[int, int, bytes]]]] = {}
    fps = {}
    for i, m in enumerate(media):
        try:
            places, fps[i] = index(m)
            out[i] = [None] * len(places)
            for j, (at, n) in enumerate(places):
                frame = m[at : at + n]
                start, h = _parse(frame, known)
                scan = frame[start:].removesuffix(b"\0").removesuffix(b"\xff\xd9")
                if h.process == 0xC3:
                    lossless.setdefault(id(h), (h, []))[1].append((i, j, scan))
                else:
                    out[i][j] = decode_baseline(scan, h)
        except (ValueError, KeyError, IndexError, struct.error, ZeroDivisionError) as e:
            out[i] = f"{type(e).__name__}: {e}"
    for h, rows in lossless.values():
        rows = [r for r in rows if not isinstance(out[r[0]], str)]
        for at in range(0, len(rows), TOGETHER):
            some = rows[at : at + TOGETHER]
            try:
                found = decode_lossless([x for _, _, x in some], h)
            except IndexError:  # a broken frame runs past the end: tell it from the others
                found = []
                for i, _, x in some:
                    try:
                        found.append(decode_lossless([x], h)[0])
                    except IndexError:
                        found.append(None)
            for (i, j, _), samples in zip(some, found, strict=True):
                if samples is None:
                    out[i] = "IndexError: broken scan"
                elif not isinstance(out[i], str):
                    out[i][j] = samples
    for i, frames in enumerate(out):
        if not isinstance(frames, str):
            if len({len(f) for f in frames}) > 1:
                out[i] = "ValueError: frames of one file differ in size"
            else:
                out[i] = (np.array(frames, np.uint8).reshape(len(frames), len(frames[0]) if frames else 0), fps[i])
    return out


def read(df: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """key, payload_bytes, payload_sha256, tail_crc32 (of the last 32 bytes), media_bytes, media_sha256, clips (timed clip
    rows, in order), error. A null file has nulls; a file without frames has no clips; of a file that can't be read only
    its own bytes and what is wrong are told, and the others go on. Repeated rows and null keys are rows like any other;
    other columns aren't read; an empty table gives an empty result."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, files in _parts(batch, 1, lambda m: len(m or b"")):
                found = iter(read_media([m for m in files if m is not None]))
                rows = []
                for m in files:
                    if m is None:
                        rows.append(dict.fromkeys(names[1:]))
                        continue
                    told = dict.fromkeys(names[1:]) | {"media_bytes": len(m), "media_sha256": hashlib.sha256(m).hexdigest()}
                    got = next(found)
                    if isinstance(got, str):
                        rows.append(told | {"error": got})
                        continue
                    samples, fps = got
                    data, hist = samples.tobytes(), histograms(samples)
                    clips = [{"first_frame": a, "frames": n, "start_s": a / fps, "end_s": (a + n) / fps, "change": round(c, 6)} for a, n, c in shots(hist)] if len(hist) else []
                    rows.append(told | {"payload_bytes": len(data), "payload_sha256": hashlib.sha256(data).hexdigest(), "tail_crc32": zlib.crc32(data[-32:]), "clips": clips})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(files)), *(pa.array([r[n] for r in rows], t) for n, t in zip(names[1:], kinds, strict=True))], names)

    names = ["k", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "clips", "error"]
    clip = pa.list_(pa.struct([("first_frame", pa.int32()), ("frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("change", pa.float64())]))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), clip, pa.string()]
    types = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(), CLIPS, T.StringType()]
    schema = T.StructType([T.StructField("k", df.schema[key].dataType), *(T.StructField(n, t) for n, t in zip(names[1:], types, strict=True))])
    return df.select(F.col(key), F.col(media)).mapInArrow(run, schema).withColumnRenamed("k", key)


def clip_rows(read_back: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each clip: key, clip (from 0), first_frame, frames, start_s, end_s, change."""
    return read_back.select(key, F.posexplode("clips").alias("clip", "c")).select(key, "clip", "c.*")
