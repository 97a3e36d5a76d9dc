"""Row-free numpy helpers used inside tasks: texts of a batch as one byte array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
GOLD = U64(0x9E3779B97F4A7C15)
MIX1 = U64(0xBF58476D1CE4E5B9)
MIX2 = U64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_binary())
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, col.offset * 8)
    base = int(offsets[0])
    size = int(offsets[-1]) - base
    if size == 0 or data is None:
        return np.zeros(0, np.uint8), offsets - base
    return np.frombuffer(data, np.uint8, size, base), offsets - base


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums with the total at the end."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each pair."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = starts_of(lengths)[:-1]
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, a, n = starts[keep], at[keep], lengths[keep]
    out[a] = s
    out[a[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays of one length as a compressed blob, byte planes apart."""
    n = len(arrays[0]) if arrays else 0
    parts = [np.ascontiguousarray(a.view(np.uint8).reshape(n, -1).T if n else np.zeros(0, np.uint8)).tobytes()
             for a in map(np.ascontiguousarray, arrays)]
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    if n == 0:
        return [np.zeros(0, d) for d in dtypes]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8)
    out, at = [], 0
    for d in map(np.dtype, dtypes):
        part = raw[at:at + n * d.itemsize].reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(part.T).view(d).reshape(n))
        at += n * d.itemsize
    return out


def squeeze(data: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(data).tobytes())


def expand(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)


def rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def xxhash64_long(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of 8-byte integers (as Spark's ``xxhash64`` of a bigint), signed."""
    # The five 64-bit primes of XXH64.
    p1, p2, p3, p4, p5 = (U64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                           0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = rotl(x.astype(np.int64).view(U64) * p2, 31) * p1
    h ^= U64((seed + int(p5) + 8) % 2**64)
    h = rotl(h, 27) * p1 + p4
    h = (h ^ (h >> U64(33))) * p2
    h = (h ^ (h >> U64(29))) * p3
    return (h ^ (h >> U64(32))).view(np.int64)


def power_tables(n: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64 (grown on demand)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 2**64), U64)
        up[0] = down[0] = U64(1)
        have = _POWERS[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return have


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def runs_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of true places; none crosses an offset."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begin[heads] = inside[heads]
    start = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = inside[tails]
    return start, np.flatnonzero(stop) + 1


def hash_runs(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]`` of 64-bit values."""
    n = len(values)
    up, down = power_tables(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(U64))
