"""64-bit ids of URLs and domains from MurmurHash3 x86 32.

`hash()` is another function (seed and tail differ), so the rounds are done here
for whole Arrow batches at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions import urls

M = np.uint64(0xFFFFFFFF)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return ((x << np.uint64(by)) | (x >> np.uint64(32 - by))) & M


def murmur3(values: list[bytes], seed: int = 0) -> np.ndarray:
    """Signed 32-bit hashes."""
    n = np.array([len(v) for v in values], dtype=np.int64)
    out = np.full(len(values), seed, dtype=np.uint64)
    for length in np.unique(n).tolist():
        at = np.flatnonzero(n == length)
        data = np.frombuffer(b"".join(values[i] for i in at), dtype=np.uint8).reshape(len(at), length).astype(np.uint64)
        h, blocks = out[at], length // 4
        for b in range(blocks):
            k = data[:, 4 * b] | data[:, 4 * b + 1] << np.uint64(8) | data[:, 4 * b + 2] << np.uint64(16) | data[:, 4 * b + 3] << np.uint64(24)
            k = _rotated(k * np.uint64(0xCC9E2D51) & M, 15) * np.uint64(0x1B873593) & M
            h = (_rotated(h ^ k, 13) * np.uint64(5) + np.uint64(0xE6546B64)) & M
        if length % 4:
            k = np.zeros(len(at), dtype=np.uint64)
            for j in range(length % 4):
                k |= data[:, 4 * blocks + j] << np.uint64(8 * j)
            h ^= _rotated(k * np.uint64(0xCC9E2D51) & M, 15) * np.uint64(0x1B873593) & M
        h ^= np.uint64(length)
        h = (h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B) & M
        h = (h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35) & M
        out[at] = h ^ (h >> np.uint64(16))
    return out.astype(np.uint32).view(np.int32).astype(np.int64)


def _hashed(texts: pa.Array) -> np.ndarray:
    return murmur3([b"" if x is None else x.encode() for x in texts.to_pylist()])


@F.arrow_udf(T.LongType())
def murmur3_32(texts: pa.Array) -> pa.Array:
    return pa.array(_hashed(texts), mask=np.array(texts.is_null()))


@F.arrow_udf(T.LongType())
def _joined(high: pa.Array, low: pa.Array) -> pa.Array:
    """(h(high) << 32) + h(low), with "" and "/index.html" as 0 and 1 in the high half; wraps as 64 bits do."""
    words = high.to_pylist()
    top = _hashed(high)
    top[[i for i, w in enumerate(words) if not w]] = 0
    top[[i for i, w in enumerate(words) if w == "/index.html"]] = 1
    with np.errstate(over="ignore"):
        return pa.array((top << np.int64(32)) + _hashed(low), mask=np.array(low.is_null()))


def url_id(url: Column) -> Column:
    """X13."""
    return _joined(F.concat(urls.normalized_subdomain(url), urls.normalized_path(url), urls.query(url)), urls.pld(url))


def domain_id(url: Column) -> Column:
    """X14."""
    return _joined(urls.normalized_subdomain(url), urls.pld(url))


def host_id(host: Column) -> Column:
    """The domain id of a bare host."""
    return domain_id(F.concat(F.lit("http://"), host))


def pld_id(url: Column) -> Column:
    """X15."""
    return murmur3_32(urls.pld(url))
