"""Files of images without an imaging library: PNG both ways, JPEG out. Other formats are read by Spark's image source."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from marlspark.kernels.raster import colour

_PNG = b"\x89PNG\r\n\x1a\n"


def png_bytes(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(h, -1)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return _PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


# The quantisation tables of the JPEG standard (Annex K), row by row.
LUMINANCE = (
    (16, 11, 10, 16, 24, 40, 51, 61),
    (12, 12, 14, 19, 26, 58, 60, 55),
    (14, 13, 16, 24, 40, 57, 69, 56),
    (14, 17, 22, 29, 51, 87, 80, 62),
    (18, 22, 37, 56, 68, 109, 103, 77),
    (24, 35, 55, 64, 81, 104, 113, 92),
    (49, 64, 78, 87, 103, 121, 120, 101),
    (72, 92, 95, 98, 112, 100, 103, 99),
)
CHROMINANCE = (
    (17, 18, 24, 47, 99, 99, 99, 99),
    (18, 21, 26, 66, 99, 99, 99, 99),
    (24, 26, 56, 99, 99, 99, 99, 99),
    (47, 66, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
    (99, 99, 99, 99, 99, 99, 99, 99),
)


def _zigzag() -> np.ndarray:
    cells = [(i, j) for i in range(8) for j in range(8)]
    return np.array([i * 8 + j for i, j in sorted(cells, key=lambda c: (sum(c), c[0] if sum(c) % 2 else c[1]))])


ZIGZAG = _zigzag()
_COSINE = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(1 / 8) if u == 0 else 0.5) for x in range(8)] for u in range(8)])


def _table(base: tuple, quality: int) -> np.ndarray:
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(base) * scale + 50) // 100, 1, 255)


def _blocks(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Quantised coefficients of each 8 x 8 block in zigzag order; edges are repeated to whole blocks."""
    h, w = plane.shape
    wide = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128.0
    parts = wide.reshape(wide.shape[0] // 8, 8, wide.shape[1] // 8, 8).transpose(0, 2, 1, 3)
    made = _COSINE @ parts @ _COSINE.T
    return np.rint(made / table).astype(np.int64).reshape(-1, 64)[:, ZIGZAG]


def _magnitude(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(size in bits, the bits) of numbers as JPEG stores them."""
    size = np.zeros(v.shape, np.int64)
    some = v != 0
    size[some] = np.floor(np.log2(np.abs(v[some]))).astype(np.int64) + 1
    return size, np.where(v < 0, v + (1 << size) - 1, v)


def _symbols(blocks: np.ndarray) -> tuple[np.ndarray, ...]:
    """(order, is AC, symbol, bits, extra) of all symbols of one component; order sorts them by block and place."""
    n = len(blocks)
    size, bits = _magnitude(np.diff(blocks[:, 0], prepend=0))
    out = [(np.arange(n) * 4096, np.zeros(n, bool), size, size, bits)]
    b, k = np.nonzero(blocks[:, 1:])
    k = k + 1
    fresh = np.concatenate([[True], b[1:] != b[:-1]]) if len(b) else np.zeros(0, bool)
    before = np.where(fresh, 0, np.concatenate([[0], k[:-1]])) if len(b) else k
    run = k - before - 1
    size, bits = _magnitude(blocks[b, k])
    at = b * 4096 + k * 8
    out.append((at + 4, np.ones(len(b), bool), (run % 16) * 16 + size, size, bits))
    for more in (1, 2, 3):  # runs of sixteen zeros
        long = np.flatnonzero(run >= 16 * more)
        z = np.zeros(len(long), np.int64)
        out.append((at[long] + more, np.ones(len(long), bool), z + 0xF0, z, z))
    last = np.zeros(n, np.int64)
    np.maximum.at(last, b, k)
    end = np.flatnonzero(last < 63)
    z = np.zeros(len(end), np.int64)
    out.append((end * 4096 + 4000, np.ones(len(end), bool), z, z, z))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """(code, length) by symbol, and the table as JPEG stores it: a Huffman code for these symbols, 16 bits at most."""
    import heapq

    count = np.bincount(symbols, minlength=256)
    heap = [(int(c), i, (i,)) for i, c in enumerate(count.tolist()) if c] + [(0, 256, (256,))]  # no code is all ones
    heapq.heapify(heap)
    depth = dict.fromkeys(range(257), 0)
    tick = 257
    while len(heap) > 1:
        (c, _, x), (d, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        for i in (*x, *y):
            depth[i] += 1
        heapq.heappush(heap, (c + d, tick, x + y))
        tick += 1
    at = [0] * 64
    for i, d in depth.items():
        if d:
            at[d] += 1
    for d in range(63, 16, -1):  # codes that are too long move up in pairs
        while at[d]:
            j = d - 2
            while not at[j]:
                j -= 1
            at[d] -= 2
            at[d - 1] += 1
            at[j + 1] += 2
            at[j] -= 1
    longest = max(d for d in range(64) if at[d])
    at[longest] -= 1  # that of the symbol which does not occur
    order = sorted((i for i in range(256) if depth[i]), key=lambda i: (-count[i], i))
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    value, k, values = 0, 0, []
    for d in range(1, 17):
        for _ in range(at[d]):
            code[order[k]], length[order[k]] = value, d
            values.append(order[k])
            value, k = value + 1, k + 1
        value <<= 1
    return code, length, at[1:17], values


def jpeg_bytes(image: np.ndarray, quality: int) -> bytes:
    """A baseline JPEG, colour without subsampling; Huffman codes are made for the image. No metadata."""
    h, w = image.shape[:2]
    if image.ndim == 2:
        planes = [image.astype(float)]
    else:
        r, g, b = (colour(image)[..., k].astype(float) for k in range(3))
        # The weights of the JFIF colour transform.
        planes = [0.299 * r + 0.587 * g + 0.114 * b, 128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 128 + 0.5 * r - 0.418688 * g - 0.081312 * b]
    tables = [_table(LUMINANCE, quality), _table(CHROMINANCE, quality)][: 1 if len(planes) == 1 else 2]
    parts = [_symbols(_blocks(np.clip(np.rint(p), 0, 255), tables[min(k, len(tables) - 1)])) for k, p in enumerate(planes)]
    segment = lambda kind, data: b"\xff" + bytes([kind]) + struct.pack(">H", len(data) + 2) + data
    out = [b"\xff\xd8", segment(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00")]
    out += [segment(0xDB, bytes([k]) + bytes(t.reshape(-1)[ZIGZAG].tolist())) for k, t in enumerate(tables)]
    out.append(segment(0xC0, struct.pack(">BHHB", 8, h, w, len(planes)) + b"".join(bytes([k + 1, 0x11, min(k, 1)]) for k in range(len(planes)))))
    value, length, order = [], [], []
    codes = {}
    for t in range(len(tables)):
        mine = [p for k, p in enumerate(parts) if min(k, 1) == t]
        for ac in (False, True):
            code, size, counts, values = _codes(np.concatenate([p[2][p[1] == ac] for p in mine]))
            codes[t, ac] = code, size
            out.append(segment(0xC4, bytes([16 * ac + t]) + bytes(counts) + bytes(values)))
    for k, (at, is_ac, symbol, bits, extra) in enumerate(parts):
        (dc, dc_size), (ac, ac_size) = codes[min(k, 1), False], codes[min(k, 1), True]
        c, s = np.where(is_ac, ac[symbol], dc[symbol]), np.where(is_ac, ac_size[symbol], dc_size[symbol])
        value.append((c << bits) | extra)
        length.append(s + bits)
        order.append((at // 4096 * 4 + k) * 4096 + at % 4096)
    sort = np.argsort(np.concatenate(order), kind="stable")
    v, n = np.concatenate(value)[sort], np.concatenate(length)[sort]
    ends = np.cumsum(n)
    place = np.arange(ends[-1]) - np.repeat(ends - n, n)
    stream = ((np.repeat(v, n) >> (np.repeat(n, n) - 1 - place)) & 1).astype(np.uint8)
    data = np.packbits(np.concatenate([stream, np.ones(-len(stream) % 8, np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00")
    out.append(segment(0xDA, bytes([len(planes)]) + b"".join(bytes([k + 1, 0x11 * min(k, 1)]) for k in range(len(planes))) + b"\x00\x3f\x00"))
    return b"".join([*out, data, b"\xff\xd9"])


def normalised(data: bytes, width: int, height: int, channels: int, modality: str) -> np.ndarray:
    """Pixels of Spark's image source (blue first) as grey or red-green-blue; RGB images always have colour."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    image = a[..., 0] if channels == 1 else a[..., 2::-1]
    return colour(image) if modality == "RGB" else np.ascontiguousarray(image)


def pixel_digest(image: np.ndarray) -> str:
    """SHA-256 of mode, size and pixels."""
    import hashlib

    mode = "L" if image.ndim == 2 else "RGB"
    return hashlib.sha256(f"{mode}|{image.shape[1]}|{image.shape[0]}|".encode("ascii") + np.ascontiguousarray(image).tobytes()).hexdigest()
