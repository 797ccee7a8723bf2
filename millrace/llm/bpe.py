"""Byte-level BPE by two tiers: a minimal perfect hash finds pre-tokens that are vocabulary entries; other pre-tokens are merged with a heap over linked bytes.

The rank file is read once by the driver, from a path that the caller gives, and sent to the tasks (its size is fixed: one line for each vocabulary entry).
Encoding and decoding need no shuffle. Ids equal those of the tiktoken library for the same ranks and pattern, without special tokens.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded each; other columns stay out of the way, whatever their names.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable
from itertools import islice

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame

from millrace.llm.rows import Memo, map_rows

LONG = 200_000


class PerfectHash:
    """Minimal perfect hash of byte strings: hash, displace by bucket, no empty slots. ``find`` gives a key's slot; for other strings, any slot."""

    def __init__(self, keys: list[bytes]):
        self.n = n = max(1, len(keys))
        self.shift = np.zeros(n, np.int64)
        buckets: dict[int, list[tuple[int, int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh3_128_intdigest(key)
            buckets.setdefault((h >> 64) % n, []).append((h & (2**32 - 1), (h >> 32) & (2**32 - 1) | 1, i))
        self.slot_of = np.full(n, -1, np.int64)
        order = sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0]))
        alone = len(order)
        for k, (bucket, members) in enumerate(order):
            if len(members) == 1:
                alone = k
                break
            d = 0
            while True:
                slots = [(lo + d * step) % n for lo, step, _ in members]
                if len(set(slots)) == len(slots) and all(self.slot_of[s] < 0 for s in slots):
                    break
                d += 1
            self.shift[bucket] = d
            for s, (_, _, i) in zip(slots, members, strict=True):
                self.slot_of[s] = i
        free = iter(np.flatnonzero(self.slot_of < 0).tolist())
        for bucket, members in order[alone:]:
            s = next(free)
            self.shift[bucket] = -s - 1
            self.slot_of[s] = members[0][2]
        self.shift = self.shift.tolist()

    def find(self, key: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(key)
        d = self.shift[(h >> 64) % self.n]
        return -d - 1 if d < 0 else ((h & (2**32 - 1)) + d * ((h >> 32) & (2**32 - 1) | 1)) % self.n


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ranks = pattern, ranks
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        self.at_slot = [(keys[i], ranks[keys[i]]) for i in self.hash.slot_of.tolist()] if keys else []
        self.bytes_of = {rank: key for key, rank in ranks.items()}

    def ids(self, piece: bytes) -> list[int]:
        key, rank = self.at_slot[self.hash.find(piece)]
        return [rank] if key == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Always the adjacent pair of lowest rank, leftmost first. Parts are linked by their start positions."""
        n, ranks = len(piece), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:  # a part that was merged away has end 0
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(piece[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out


def read_codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return Codec(ranks, pattern)


def encoder(codec: Codec):
    """A function from text to ids as little-endian 32-bit integers. Pre-tokens seen before are not looked up again."""
    split = regex.compile(codec.pattern)
    packed = Memo(lambda piece: np.array(codec.ids(piece.encode()), "<u4").tobytes())

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= LONG:
            return b"".join(map(packed.__getitem__, split.findall(text)))
        pieces, out = (m.group() for m in split.finditer(text)), []
        while some := list(islice(pieces, 50_000)):
            out.append(b"".join(map(packed.__getitem__, some)))
        return b"".join(out)

    return encode


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ``ids`` (little-endian unsigned 32-bit integers)."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def start():
        to_ids = encoder(shared.value)

        def row(key, text) -> Iterable[tuple]:
            ids = to_ids(text)
            return [(key, len(ids) // 4, ids)]

        return row

    source = docs.select(id_col, text_col)
    return map_rows(source, start, f"`{id_col}` {source.dtypes[0][1]}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, codec: Codec, id_col: str = "doc_id") -> DataFrame:
    """The encoded rows with ``decoded``: the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def start():
        bytes_of = shared.value.bytes_of

        def row(key, n_tokens, ids) -> Iterable[tuple]:
            out = [b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4", min(50_000, n_tokens - i), i * 4).tolist())) for i in range(0, n_tokens, 50_000)]
            return [(key, n_tokens, ids, b"".join(out))]

        return row

    source = encoded.select(id_col, "n_tokens", "ids")
    return map_rows(source, start, f"`{id_col}` {source.dtypes[0][1]}, n_tokens bigint, ids binary, decoded binary")
