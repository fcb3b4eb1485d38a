"""Plain PNG files as input of the image queries and tests."""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def png_bytes(pixels: bytes, width: int, height: int, channels: int) -> bytes:
    """Plain PNG of 8-bit grey (1), RGB (3) or RGBA (4) pixels."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    stride = width * channels
    lines = b"".join(b"\0" + pixels[i * stride : (i + 1) * stride] for i in range(height))
    kind = {1: 0, 3: 2, 4: 6}[channels]
    header = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


def png_column(levels: Column, width: int, height: int, channels: int = 1) -> Column:
    """PNG file of an array of 0..255 levels."""

    @F.arrow_udf("binary")
    def encode(cells: pa.Array) -> pa.Array:
        return pa.array(
            [png_bytes(bytes(c), width, height, channels) if c else None for c in cells.to_pylist()],
            pa.binary(),
        )

    return encode(levels)
