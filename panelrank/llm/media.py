"""Media columns (operator 6): Netpbm and BMP images held in binary columns.

`store_bytes` writes any bytes losslessly as a grey 8-bit image. `inspect` decodes images (P1 to P6, and BMP of 8,
24 or 32 bits without compression) to numpy arrays, resizes them by area with integral images, and returns an NPY
tile and a difference hash for each. Null, empty or damaged images get null results and the reason in `error`.
Equal bytes give equal results; rows are independent, so repeated rows, ties and extra columns pass through.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Samples in a row of a stored image.
WIDTH = 64
#: Rows summed at a time; bounds the memory of an integral image.
BLOCK_ROWS = 4096


def pad(data: bytes, width: int = WIDTH) -> bytes:
    """Bytes 0 up to a positive multiple of `width`."""
    return data + bytes(-len(data) % width if data else width)


def to_pgm(payload: bytes, width: int = WIDTH) -> bytes:
    return b"P5\n%d %d\n255\n" % (width, len(payload) // width) + payload


def to_bmp(payload: bytes, width: int = WIDTH) -> bytes:
    """An 8-bit grey BMP, rows from the bottom up; `width` must be a multiple of 4."""
    height = len(payload) // width
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    rows = np.frombuffer(payload, np.uint8).reshape(height, width)[::-1].tobytes()
    head = struct.pack("<2sIHHI", b"BM", 54 + len(palette) + len(rows), 0, 0, 54 + len(palette))
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8, 0, len(rows), 2835, 2835, 256, 256) + palette + rows


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, numbers = data[1] - 48, 2, []
    while len(numbers) < (2 if kind in (1, 4) else 3):
        m = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(data, at)
        if not m:
            raise ValueError("bad Netpbm header")
        numbers.append(int(m[1]))
        at = m.end()
    width, height, top = numbers[0], numbers[1], (numbers + [1])[2]
    if width < 1 or height < 1 or not 0 < top < 65536:
        raise ValueError("bad Netpbm size")
    depth = 3 if kind in (3, 6) else 1
    count = width * height * depth
    if kind <= 3:
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        flat = np.array([int(x) for x in (re.findall(rb"[01]", body) if kind == 1 else body.split())][:count], np.uint32)
    elif kind == 4:
        stride = (width + 7) // 8
        raw = np.frombuffer(data, np.uint8, stride * height, at + 1).reshape(height, stride)
        flat = np.unpackbits(raw, axis=1)[:, :width].ravel().astype(np.uint32)
    else:
        flat = np.frombuffer(data, np.uint8 if top < 256 else ">u2", count, at + 1)
    if flat.size != count:
        raise ValueError("Netpbm samples are missing")
    if kind in (1, 4):
        flat = (1 - flat) * 255
    elif top != 255:
        flat = (flat.astype(np.uint64) * 255 + top // 2) // top
    return flat.astype(np.uint8, copy=False).reshape((height, width, depth) if depth > 1 else (height, width))


def _bmp(data: bytes) -> np.ndarray:
    start = struct.unpack_from("<I", data, 10)[0]
    size, width, height, _, bits, packed = struct.unpack_from("<IiiHHI", data, 14)
    if packed or bits not in (8, 24, 32) or width < 1 or not height:
        raise ValueError("unsupported BMP")
    rows, stride = abs(height), (width * bits // 8 + 3) // 4 * 4
    raw = np.frombuffer(data, np.uint8, stride * rows, start).reshape(rows, stride)[:, : width * bits // 8]
    raw = raw[::-1] if height > 0 else raw
    if bits > 8:
        return np.ascontiguousarray(raw.reshape(rows, width, bits // 8)[:, :, 2::-1])
    used = struct.unpack_from("<I", data, 46)[0] or 256
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + size).reshape(used, 4)[:, 2::-1]
    if (palette == palette[:, :1]).all():
        return palette[:, 0][raw]
    return palette[raw]


def decode(data: bytes) -> np.ndarray:
    """An image as a uint8 array: rows x columns, with a third axis of 3 when it has colours."""
    if data[:1] == b"P" and data[1:2] in b"123456" and len(data) > 2:
        return _netpbm(data)
    if data[:2] == b"BM" and len(data) > 54:
        return _bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def _edges(image: np.ndarray, count: int) -> np.ndarray:
    """Sums of all rows above each of count + 1 evenly spaced edges, which may cut through a row."""
    height = image.shape[0]
    edge = np.arange(count + 1) * height / count
    whole = np.minimum(edge.astype(np.int64), height)
    out = np.empty((count + 1, *image.shape[1:]))
    above = np.zeros(image.shape[1:])
    for a in range(0, height, BLOCK_ROWS):
        integral = np.concatenate([above[None], above + np.cumsum(image[a : a + BLOCK_ROWS], axis=0, dtype=np.float64)])
        inside = (whole >= a) & (whole < a + integral.shape[0])
        out[inside] = integral[whole[inside] - a]
        above = integral[-1]
    part = edge - whole
    cut = part > 0
    out[cut] += image[whole[cut]] * part[cut].reshape(-1, *[1] * (image.ndim - 1))
    return out


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over the area of each target sample, from differences of integral images; exact for any two sizes."""
    rows = np.diff(_edges(image, height), axis=0)
    cells = np.diff(_edges(rows.swapaxes(0, 1), width), axis=0).swapaxes(0, 1)
    return cells * (height * width / (image.shape[0] * image.shape[1]))


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else (image.astype(np.uint32) @ np.array([299, 587, 114], np.uint32) // 1000).astype(np.uint8)


def difference_hash(image: np.ndarray, side: int = 8) -> str:
    """Hexadecimal digits of side * side bits: is a cell brighter than its left neighbour?"""
    cells = np.round(area_resize(grey(image), side, side + 1), 6)
    return np.packbits(cells[:, 1:] > cells[:, :-1]).tobytes().hex()


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def store_bytes(df: DataFrame, column: str, out: str = "media", kind: str = "pgm", width: int = WIDTH) -> DataFrame:
    """Replaces a string or binary column by `out`: its bytes (UTF-8), padded, as an image of the given kind. Null: empty."""
    kept = [c for c in df.columns if c not in (column, out, "n_bytes")]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("n_bytes", T.LongType()), T.StructField(out, T.BinaryType())])
    write = {"pgm": to_pgm, "bmp": to_bmp}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                raw = [x if isinstance(x, bytes) else (x or "").encode("utf-8") for x in part.column(column).to_pylist()]
                media = pa.array([write(pad(x, width), width) for x in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array([len(x) for x in raw], pa.int64()), media], [*kept, "n_bytes", out])

    return df.select(*kept, column).mapInArrow(run, schema)


FOUND = "height int, width int, channels int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tile binary, dhash string, error string"


def _found(data: bytes | None, tile: int) -> tuple:
    if not data:
        return (*[None] * 10, "empty")
    try:
        image = decode(data)
    except (ValueError, struct.error, IndexError) as error:
        return (*[None] * 6, len(data), sha256(data).hexdigest(), None, None, str(error)[:200])
    payload = image.tobytes()
    small = np.clip(np.round(area_resize(image, tile, tile)), 0, 255).astype(np.uint8)
    return (image.shape[0], image.shape[1], 1 if image.ndim == 2 else 3, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]),
            len(data), sha256(data).hexdigest(), npy(small), difference_hash(image), None)


def inspect(df: DataFrame, column: str = "media", tile: int = 16) -> DataFrame:
    """Reads the images of a binary column and adds the columns of FOUND; drops the images and clashing columns."""
    found = T._parse_datatype_string(FOUND)
    kept = [c for c in df.columns if c != column and c not in found.names]
    schema = T.StructType([df.schema[c] for c in kept] + found.fields)
    kinds = [pa.int32()] * 3 + [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                rows = [_found(x, tile) for x in part.column(column).to_pylist()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *columns], schema.names)

    return df.select(*kept, column).mapInArrow(run, schema)
