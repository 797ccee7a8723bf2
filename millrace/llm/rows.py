"""Arrow-batched row functions and word hashing shared by the operators that need Python inside tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

WORD = re.compile(r"\w+")
FEW = 128


def map_rows(df: DataFrame, start: Callable[[], Callable[..., Iterable[tuple]]], schema: str, few: int = FEW) -> DataFrame:
    """``start()`` is called once a task and returns a function from one row's values to output rows.

    Input batches are worked off a few rows at a time, and output leaves in batches as small, so memory holds one input batch and little else.
    """
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(kind)
        fn = start()
        for batch in batches:
            for at in range(0, batch.num_rows, few):
                part = batch.slice(at, few)
                out = [row for values in zip(*(c.to_pylist() for c in part.columns), strict=True) for row in fn(*values)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=types)

    return df.mapInArrow(run, kind)


class Memo(dict):
    """Remembers what ``make`` returns, for ``most`` keys at a time."""

    def __init__(self, make: Callable, most: int = 200_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def word_hashes() -> Memo:
    return Memo(lambda word: xxhash.xxh3_64_intdigest(word.encode()))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hashed(tokens: list[str], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words, in order; a shorter text is one window, no words give none."""
    n = len(ids) - k + 1
    if n < 1:
        n, k = min(1, len(ids)), len(ids)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n]
    return mixed(total + np.uint64(k))


@lru_cache(1)
def _word_characters() -> np.ndarray:
    """Whether each character belongs to words."""
    known = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    known[ord("_")] = True
    return known


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as the longest text so far has characters."""

    base = 0x9E3779B97F4A7C15
    up = down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            steps = [np.full(n, x, np.uint64) for x in (self.base, pow(self.base, -1, 2**64))]
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.cumprod(s) for s in steps)


_POWERS = _Powers()


def word_numbers(text: str | None) -> np.ndarray:
    """A 64-bit number for each word of ``words(text)``, equal for equal words. Differences of one running sum over the characters, so that no word becomes a Python string."""
    if not text:
        return np.zeros(0, np.uint64)
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(chars) + 2, bool)
    inside[1:-1] = _word_characters()[chars]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    _POWERS.grow(len(chars))
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars + np.uint32(1)) * _POWERS.up[: len(chars)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * _POWERS.down[begins])
