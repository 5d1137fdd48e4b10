"""Media columns: payloads kept losslessly in baseline JPEG, and JPEG features.

``encode_jpeg`` stores a payload as the quantised DCT coefficients of 8x8
luminance blocks (64 bytes a block, in zigzag order) of a baseline JPEG: SOF0,
one DC and one AC Huffman table, a quantisation table of ones, and a restart
marker after every few blocks.  Entropy coding is lossless, so the coefficients
read back are the payload.  ``decode_jpeg`` parses the markers of any
single-component baseline JPEG and decodes its scan: the restart intervals are
decoded side by side in numpy, one symbol of every interval a step.  The
thumbnail takes the DC coefficient of each block as one pixel; its average hash
is the feature.

Defined cases: a null or empty text is one block of zeros; equal texts give
equal rows; repeated rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import SLICE_BYTES, byte_slices, text_buffers

#: Blocks a row of the image at most, and blocks between restart markers.
ROW_BLOCKS, INTERVAL = 64, 4


def pad_payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def _dht(kind: int, lengths: dict[int, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """DHT segment, and code and length by symbol, of a table given by code lengths."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    counts = [sum(lengths[s] == n for s in order) for n in range(1, 17)]
    code, size = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    at = last = 0
    for s in order:
        at <<= lengths[s] - last
        last = lengths[s]
        code[s], size[s] = at, last
        at += 1
    body = bytes([kind, *counts, *order])
    return b"\xff\xc4" + struct.pack(">H", len(body) + 2) + body, code, size


def _code_lengths() -> tuple[dict[int, int], dict[int, int]]:
    """Lengths of the DC categories, and of the AC (run, size) symbols: sizes 7
    and 6 without a run, which letters and spaces have, are short."""
    dc = {s: 4 for s in range(12)}
    ac = {0x07: 1, 0x06: 2, 0x08: 4, 0x05: 5, 0x00: 5, 0xF0: 8, 0x04: 8, 0x03: 8, 0x02: 9, 0x01: 9}
    ac |= {(run << 4) | size: 13 for run in range(1, 16) for size in range(1, 11)}
    ac |= {0x09: 13, 0x0A: 13}
    return dc, ac


_DC_LENGTHS, _AC_LENGTHS = _code_lengths()
_DC_SEGMENT, _DC_CODE, _DC_SIZE = _dht(0x00, _DC_LENGTHS)
_AC_SEGMENT, _AC_CODE, _AC_SIZE = _dht(0x10, _AC_LENGTHS)
#: Bits of a magnitude up to 2047.
_BITS = np.array([int(x).bit_length() for x in range(4096)], np.int64)


def _pack(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> bytes:
    """Bits of consecutive codes; after the codes at ``ends`` a restart marker
    follows, but for the last.  Stuffs 0 after 0xFF."""
    at = np.cumsum(sizes)
    stop = at[ends]
    start = np.concatenate(([0], stop[:-1]))
    n_bytes = -(-(stop - start) // 8)
    first = np.concatenate(([0], np.cumsum(n_bytes)[:-1]))  # first byte of each interval
    part = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([-1], ends))))
    bit = at - sizes - start[part] + 8 * first[part]
    total = int(first[-1] + n_bytes[-1])
    words = np.zeros(total // 4 + 3, np.uint64)
    word, shift = bit >> 5, bit & 31
    wide = codes.astype(np.uint64) << (64 - sizes - shift).astype(np.uint64)
    high, low = wide >> np.uint64(32), wide & np.uint64(0xFFFFFFFF)
    for value, index in ((high, word), (low, word + 1)):
        heads = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
        words[index[heads]] |= np.bitwise_or.reduceat(value, heads)
    raw = words.astype(">u4").view(np.uint8)[:total].copy()
    unused = (8 * n_bytes - (stop - start)).astype(np.int64)
    raw[first + n_bytes - 1] |= ((1 << unused) - 1).astype(np.uint8)  # fill with ones
    # Insert a 0 after each 0xFF, then the markers between intervals.
    grow = np.ones(total, np.int64)
    grow[raw == 255] += 1
    grow[(first + n_bytes - 1)[:-1]] += 2
    place = np.cumsum(grow) - grow
    out = np.zeros(int(place[-1] + grow[-1]), np.uint8)
    out[place] = raw
    marks = (place + grow)[(first + n_bytes - 1)[:-1]] - 2
    out[marks] = 0xFF
    out[marks + 1] = 0xD0 + np.arange(len(marks)) % 8
    return out.tobytes()


def encode_jpeg(payload: bytes) -> bytes:
    """A payload of a multiple of 64 bytes as a baseline JPEG."""
    coefficients = np.frombuffer(payload, np.uint8).astype(np.int64).reshape(-1, 64)
    n = len(coefficients)
    across = min(n, ROW_BLOCKS)
    down = -(-n // across)
    if 8 * down > 65535:  # a larger payload takes a wider image
        across = -(-n // 8191)
        down = -(-n // across)
    blocks = np.zeros((across * down, 64), np.int64)
    blocks[:n] = coefficients
    dc = blocks[:, 0].copy()
    dc[1:] -= blocks[:-1, 0]
    dc[::INTERVAL] = blocks[::INTERVAL, 0]
    size = _BITS[np.abs(dc)]
    value = np.where(dc < 0, dc + (1 << size) - 1, dc)
    rows = np.arange(len(blocks))
    dc_code, dc_size = (_DC_CODE[size] << size.astype(np.uint64)) | value.astype(np.uint64), _DC_SIZE[size] + size
    r, c = np.nonzero(blocks[:, 1:])
    v = blocks[r, c + 1]
    before = np.where(np.concatenate(([True], r[1:] != r[:-1]))[: len(r)], -1, np.concatenate(([-1], c[:-1]))[: len(r)])
    run = c - before - 1
    s = _BITS[v]
    symbol = ((run & 15) << 4) | s
    ac_code, ac_size = (_AC_CODE[symbol] << s.astype(np.uint64)) | v.astype(np.uint64), _AC_SIZE[symbol] + s
    key = r * 256 + (c + 1) * 2 + 1
    parts = [(rows * 256, dc_code, dc_size), (key, ac_code, ac_size)]
    for k in range(1, 4):  # runs of 16 zeros and more
        long = np.flatnonzero(run >= 16 * k)
        parts.append((key[long] - 1, np.full(len(long), _AC_CODE[0xF0]), np.full(len(long), _AC_SIZE[0xF0])))
    open_rows = np.flatnonzero(blocks[:, 63] == 0)  # end of block
    parts.append((open_rows * 256 + 255, np.full(len(open_rows), _AC_CODE[0]), np.full(len(open_rows), _AC_SIZE[0])))
    keys, codes, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, codes, sizes = keys[order], codes[order], sizes[order]
    part = (keys >> 8) // INTERVAL
    ends = np.flatnonzero(np.concatenate((part[1:] != part[:-1], [True])))
    scan = _pack(codes, sizes, ends)
    frame = struct.pack(">BHHBBBB", 8, 8 * down, 8 * across, 1, 1, 0x11, 0)
    note = struct.pack(">Q", len(payload))
    return b"".join((
        b"\xff\xd8",
        b"\xff\xfe", struct.pack(">H", len(note) + 2), note,
        b"\xff\xdb", struct.pack(">HB", 67, 0), b"\x01" * 64,
        b"\xff\xc0", struct.pack(">H", len(frame) + 2), frame,
        _DC_SEGMENT, _AC_SEGMENT,
        b"\xff\xdd", struct.pack(">HH", 4, INTERVAL),
        b"\xff\xda", struct.pack(">HBBBBBB", 8, 1, 1, 0x00, 0, 63, 0),
        scan, b"\xff\xd9",
    ))


@dataclass
class Jpeg:
    width: int
    height: int
    blocks: np.ndarray  # (n, 64) quantised coefficients in zigzag order
    quant: np.ndarray
    across: int
    note: bytes


def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For each 16 bits that may come: code length * 256 + symbol; 0: no code."""
    out = np.zeros(1 << 16, np.int32)
    code = at = 0
    for n in range(1, 17):
        for _ in range(counts[n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = n * 256 + symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _windows(raw: np.ndarray) -> np.ndarray:
    """At each byte the next four bytes as one number, and the fifth and sixth below."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    n = len(raw) + 1
    out = np.zeros(n, np.uint64)
    for k in range(6):
        out <<= np.uint64(8)
        out |= padded[k : k + n]
    return out


@dataclass
class _Scan:
    """An entropy-coded scan: its bytes, blocks, restart interval and tables."""

    data: np.ndarray
    n_blocks: int
    interval: int
    dc: np.ndarray
    ac: np.ndarray


def _intervals(scan: _Scan) -> tuple[np.ndarray, np.ndarray]:
    """Bytes without stuffing and markers, and where each restart interval begins."""
    ff = np.flatnonzero(scan.data[:-1] == 255)
    follow = scan.data[ff + 1]
    marks = ff[(follow >= 0xD0) & (follow <= 0xD7)]
    keep = np.ones(len(scan.data), bool)
    keep[ff[follow == 0] + 1] = False
    keep[marks] = keep[marks + 1] = False
    begin = np.concatenate(([0], marks - 2 * np.arange(len(marks)) - np.searchsorted(ff[follow == 0], marks)))
    return scan.data[keep], begin


def _decode_scans(scans: list[_Scan]) -> list[np.ndarray]:
    """Quantised coefficients of single-component scans.  All restart intervals
    of all scans go forward together, a symbol of each a step."""
    raws, begins, counts, first, tables, base = [], [], [], [], [], []
    known: dict[tuple[int, int], int] = {}
    at = blocks = 0
    for scan in scans:
        raw, begin = _intervals(scan)
        per = scan.interval or scan.n_blocks
        lanes = len(begin)
        if lanes != -(-scan.n_blocks // per):
            raise ValueError("restart markers don't fit the image")
        count = np.full(lanes, per, np.int64)
        count[-1] = scan.n_blocks - per * (lanes - 1)
        key = (id(scan.dc), id(scan.ac))
        if key not in known:
            known[key] = len(tables) << 16
            tables += [scan.dc, scan.ac]
        base.append(np.full(lanes, known[key], np.int64))
        raws.append(raw)
        begins.append(begin + at)
        counts.append(count)
        first.append(blocks + per * np.arange(lanes, dtype=np.int64))
        at += len(raw)
        blocks += scan.n_blocks
    windows, codes = _windows(np.concatenate(raws)), np.concatenate(tables)
    flat = np.zeros(blocks * 64, np.int16)
    pos, count, table = np.concatenate(begins) * 8, np.concatenate(counts), np.concatenate(base)
    place = np.concatenate(first) * 64  # next coefficient of the lane; blocks are multiples of 64
    goal = place + count * 64
    previous = np.zeros(len(pos), np.int64)
    while len(place):
        is_dc = (place & 63) == 0
        window = (windows[pos >> 3] << (pos & 7).astype(np.uint64)) & np.uint64(0xFFFFFFFFFFFF)
        found = codes[(window >> np.uint64(32)).astype(np.int64) + table + np.where(is_dc, 0, 1 << 16)].astype(np.int64)
        used, symbol = found >> 8, found & 255
        if not used.all():
            raise ValueError("no such Huffman code")
        size = symbol & 15
        one = np.int64(1) << size
        bits = (window >> (48 - used - size).astype(np.uint64)).astype(np.int64) & (one - 1)
        value = np.where(bits < (one >> 1), bits - one + 1, bits)
        pos += used + size
        value += np.where(is_dc, previous, 0)
        previous = np.where(is_dc, value, previous)
        end = ~is_dc & (symbol == 0)
        target = place + np.where(is_dc, 0, symbol >> 4)
        put = is_dc | (size > 0)
        flat[target[put]] = value[put]
        place = np.where(end, (place | 63) + 1, target + 1)
        stay = place < goal
        if not stay.all():
            place, pos, previous, goal, table = place[stay], pos[stay], previous[stay], goal[stay], table[stay]
    bounds = np.cumsum([0, *(x.n_blocks for x in scans)]) * 64
    return [flat[a:b].reshape(-1, 64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(maxsize=64)
def _table(body: bytes) -> np.ndarray:
    return _lookup(body[:16], body[16:])


def parse_jpeg(data: bytes) -> tuple[_Scan, dict]:
    """Markers of a baseline JPEG with one component: its scan and the rest."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    at, tables, quant, interval, frame, note = 2, {}, {}, 0, None, b""
    while True:
        if data[at] != 0xFF:
            raise ValueError("marker expected")
        marker, length = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xC0:
            frame = struct.unpack_from(">BHHBBBB", body)
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _table(bytes(body[1 : 17 + n]))
                body = body[17 + n :]
        elif marker == 0xDB:
            while body:
                quant[body[0] & 15] = np.frombuffer(body[1:65], np.uint8)
                body = body[65:]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xFE:
            note = body
        elif marker == 0xDA:
            break
        elif 0xC1 <= marker <= 0xCF:
            raise ValueError("not baseline")
    if frame is None or frame[0] != 8 or frame[3] != 1 or body[0] != 1:
        raise ValueError("one 8-bit component is expected")
    _, height, width, _, _, _, table = frame
    across, down = -(-width // 8), -(-height // 8)
    end = data.rfind(b"\xff\xd9")
    scan = np.frombuffer(data, np.uint8, end - at, at)
    choose = body[2]
    entropy = _Scan(scan, across * down, interval, tables[choose >> 4], tables[0x10 | (choose & 15)])
    return entropy, {"width": width, "height": height, "quant": quant[table], "across": across, "note": note}


def decode_jpegs(stored: list[bytes]) -> list[Jpeg]:
    if not stored:
        return []
    scans, rest = zip(*map(parse_jpeg, stored), strict=True)
    return [Jpeg(blocks=blocks, **x) for blocks, x in zip(_decode_scans(list(scans)), rest, strict=True)]


def decode_jpeg(data: bytes) -> Jpeg:
    return decode_jpegs([data])[0]


def thumbnail(image: Jpeg) -> np.ndarray:
    """One pixel a block from the DC coefficients: the block's mean luminance."""
    dc = image.blocks[:, 0].astype(np.int64) * int(image.quant[0])
    return np.clip(dc // 8 + 128, 0, 255).astype(np.uint8).reshape(-1, image.across)


def average_hash(pixels: np.ndarray, side: int = 8) -> str:
    """Hash of side x side cells: a bit for each cell above the mean."""
    h, w = pixels.shape
    rows, cols = np.arange(side) * h // side, np.arange(side) * w // side
    cells = pixels[np.ix_(rows, cols)].astype(np.float64)
    bits = (cells > cells.mean()).reshape(-1)
    return np.packbits(bits).tobytes().hex()


def read_payload(image: Jpeg) -> bytes:
    (length,) = struct.unpack(">Q", image.note)
    return image.blocks.reshape(-1)[:length].astype(np.uint8).tobytes()


def _map(df: DataFrame, column: str, keep: list[str], schema: str, make) -> DataFrame:
    """``keep`` columns and what ``make`` returns for bytes and bounds of ``column``,
    in slices of bounded bytes."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(len(keep)))
            for i, j in byte_slices(bounds, 2 * SLICE_BYTES):
                part = batch.slice(i, j - i)
                kept = [part.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *make(data, bounds[i : j + 1])], names=names)

    return df.select(*keep, column).mapInArrow(run, schema)


def store_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's padded payload as a JPEG."""

    def make(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        media = [encode_jpeg(pad_payload(data[a:b].tobytes())) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return [pa.array(np.diff(bounds), pa.int64()), pa.array(media, pa.binary())]

    return _map(df, text_col, [id_col], f"{id_col} {dict(df.dtypes)[id_col]}, n_bytes long, media binary", make)


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width int, height int, thumb_sha256 string, feature string"


def media_features(media: DataFrame, keep: list[str], media_col: str = "media") -> DataFrame:
    """Read stored media back: payload digests, dimensions and thumbnail hashes."""

    def make(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        rows = []
        items = [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for stored, image in zip(items, decode_jpegs(items), strict=True):
            payload, small = read_payload(image), thumbnail(image)
            feature = average_hash(small)
            rows.append((
                len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(),
                image.width, image.height, hashlib.sha256(small.tobytes()).hexdigest(), f"{image.width}x{image.height}:{feature}",
            ))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [()] * len(types)
        return [pa.array(c, t) for c, t in zip(columns, types, strict=True)]

    types = dict(media.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keep) + ", " + FEATURES
    return _map(media, media_col, keep, schema, make)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text"))
    return media_features(store_media(docs), ["doc_id", "n_bytes"])
