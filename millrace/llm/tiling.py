"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of word hashes. Windows of ``least`` words that occur in the benchmark are the seeds. A filter of fixed size, built from the
benchmark's seeds, picks the stretches of each document that can match; an equi-join of seeds then names the candidate pairs. For each pair the longest matches that do not
overlap are marked one after the other, found by running Karp-Rabin sums at halved differences of length. A document is contaminated by an item when the tiles cover at least
``coverage`` of the item's words, in whatever order they stand.

Defined cases: null and empty texts match nothing; very long texts and texts of few words over and over take near-linear time; items of fewer than ``least`` words have no seed and contaminate nothing; rows that share id and text are judged once, rows that
share an id but not the text each, and the pair's best coverage counts; null ids are judged like others; repeated items (same id) count by their best, each text by itself; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import hashed, map_rows, shingles, word_hashes, words
from millrace.sources.session import cut_lineage

BASE = 0x9E3779B97F4A7C15
BITMAP = 32_768


class Words:
    """A sequence of word hashes with its running Karp-Rabin sums modulo 2**64, and flags of the words that no tile holds yet."""

    def __init__(self, words: Iterable[int]):
        self.words = np.asarray(words, np.uint64)
        n = len(self.words)
        self.sums, self.back = np.zeros(n + 1, np.uint64), powers(pow(BASE, -1, 1 << 64), n)
        np.cumsum(self.words * powers(BASE, n), out=self.sums[1:])
        self.free = bytearray(b"\1" * n)
        self.settle()

    def settle(self) -> None:
        """Takes note of the flags as they are now."""
        self.held = np.concatenate([[0], np.cumsum(np.frombuffer(self.free, np.uint8) == 0)])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of ``size`` words that were free when last noted."""
        at = np.flatnonzero(self.held[size:] == self.held[: max(0, len(self.held) - size)])
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]

    def is_free(self, at: int, size: int) -> bool:
        """Tiles are never shorter than the window in question, so one that meets the window holds its first or last word."""
        return bool(self.free[at] and self.free[at + size - 1])

    def hold(self, at: int, size: int) -> None:
        self.free[at : at + size] = bytes(size)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(seq: Iterable[int], size: int) -> Iterable[tuple[int, int]]:
    """(start, Karp-Rabin hash) of all windows of ``size``."""
    return enumerate(Words(seq).windows(size)[1].tolist())


def longest_shared(item: Words, text: Words, least: int, most: int) -> int:
    """The greatest size from ``least`` to ``most`` at which free windows share a hash, 0 if there is none. What shares a window shares all shorter ones, so sizes are halved."""

    def shared(size: int) -> bool:
        return bool(np.isin(item.windows(size)[1], text.windows(size)[1]).any())

    if most < least or not shared(least):
        return 0
    if shared(most):
        return most
    while most - least > 1:
        size = (least + most) // 2
        least, most = (size, most) if shared(size) else (least, size)
    return least


def mark(item: Words, text: Words, size: int) -> Iterable[tuple[int, int]]:
    """Marks equal free windows of ``size`` until there are none, leftmost in the item and then in the text first: (item start, text start)."""
    (at, h), (to, k) = item.windows(size), text.windows(size)
    at, h = at[np.isin(h, k)], h[np.isin(h, k)]
    order = np.argsort(k, kind="stable")
    to, k = to[order], k[order]
    begins, ends = np.searchsorted(k, h, "left").tolist(), np.searchsorted(k, h, "right").tolist()
    passed: dict[int, int] = {}  # up to here all places of a hash are held
    for a, begin, end in zip(at.tolist(), begins, ends):
        if not item.is_free(a, size):
            continue
        i = passed.get(begin, begin)
        while i < end and not text.is_free(int(to[i]), size):
            i += 1
        passed[begin] = i
        while i < end and not (text.is_free(t := int(to[i]), size) and np.array_equal(item.words[a : a + size], text.words[t : t + size])):
            i += 1  # different words under one hash
        if i < end:
            item.hold(a, size)
            text.hold(t, size)
            yield a, t
    item.settle()
    text.settle()


def tiles(item: Iterable[int], text: Iterable[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, item start, text start), the longest first, no word in two tiles.

    All tiles of one length are marked in one pass, and tiles of d lengths hold d * d / 2 words: a pass is near-linear in both sequences, passes grow with the root of the shorter one at worst,
    and places of a repeated window are never paired with one another.
    """
    a, t = Words(item), Words(text)
    out, most = [], min(len(a.words), len(t.words))
    while size := longest_shared(a, t, least, most):
        out += [(size, i, j) for i, j in mark(a, t, size)]
        most = size - 1
    return out


def seeds_of_items(benchmark: DataFrame, least: int, item_col: str, text_col: str) -> DataFrame:
    """item, a digest of its words, its word hashes, its seeds and how often each occurs."""

    def start():
        memo = word_hashes()

        def row(item, text) -> Iterable[tuple]:
            ids = hashed(words(text), memo)
            if len(ids) < least:
                return []
            found, counts = np.unique(shingles(ids, least), return_counts=True)
            return [(item, ids.tobytes(), found.view(np.int64), counts)]

        return row

    source = benchmark.select(item_col, text_col).distinct()
    return map_rows(source, start, f"item {source.dtypes[0][1]}, ids binary, seeds array<bigint>, counts array<bigint>").withColumn("digest", F.xxhash64("ids"))


def seed_filter(items: DataFrame, bits: int) -> np.ndarray:
    """Table of ``2**bits`` flags, two for each seed. At most 2**bits / 8 bytes reach the driver, however large the benchmark is."""
    mask = F.lit((1 << bits) - 1)
    seed = items.select(F.explode("seeds").alias("h"))
    place = seed.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftright("h", 32).bitwiseAND(mask))).alias("p"))
    part = place.select((F.floor(F.col("p") / BITMAP)).alias("part"), (F.col("p") % BITMAP).alias("bit"))
    table = np.zeros(1 << bits, np.uint8)
    for r in part.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("flags")).collect():
        flags = np.unpackbits(np.frombuffer(bytes(r["flags"]), np.uint8), bitorder="little")
        table[r["part"] * BITMAP : (r["part"] + 1) * BITMAP] |= flags
    return table


def stretches(docs: DataFrame, table: np.ndarray, bits: int, least: int, id_col: str, text_col: str) -> DataFrame:
    """Documents with seeds: key (id and text hash), seeds, and the words of the stretches they cover, parted by a zero."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    mask = np.uint64((1 << bits) - 1)

    def start():
        memo, flags = word_hashes(), shared.value

        def row(key, tag, text) -> Iterable[tuple]:
            ids = hashed(words(text), memo)
            if len(ids) < least:
                return []
            h = shingles(ids, least)
            hit = np.flatnonzero(flags[h & mask] & flags[(h >> np.uint64(32)) & mask])
            if not len(hit):
                return []
            runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
            parts = [x for run in runs for x in (ids[run[0] : run[-1] + least], np.zeros(1, np.uint64))]
            return [(key, tag, np.unique(h[hit]).view(np.int64), np.concatenate(parts).tobytes())]

        return row

    source = docs.select(id_col, F.xxhash64(text_col).alias("tag"), text_col)
    return map_rows(source, start, f"id {source.dtypes[0][1]}, tag bigint, seeds array<bigint>, text binary").distinct()


def judged(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bits: int = 24) -> DataFrame:
    """(key, item, coverage, n_tiles, longest) for every contaminated pair of a document's key (id and text hash) and an item's text."""
    items = cut_lineage(seeds_of_items(benchmark, least, item_col, "text"), "benchmark-seeds")
    found = cut_lineage(stretches(docs, seed_filter(items, bits), bits, least, id_col, text_col).withColumn("key", F.struct("id", "tag")), "benchmark-stretches")
    by_item = items.select("item", "digest", (F.octet_length("ids") / 8).alias("n_words"), F.explode(F.arrays_zip("seeds", "counts")).alias("s")).select("item", "digest", "n_words", F.col("s.seeds").alias("h"), "s.counts")
    shared = found.select("key", F.explode("seeds").alias("h")).join(by_item, "h")
    pairs = shared.groupBy("key", "item", "digest").agg(F.sum("counts").alias("n"), F.max("n_words").alias("n_words"))
    # Seeds that stand at n places of the item cover at most least * n of its words.
    pairs = pairs.where(F.col("n") * least >= F.col("n_words") * coverage).select("key", "item", "digest")
    ready = pairs.join(found.select("key", "text"), "key").join(items.select("item", "digest", "ids"), ["item", "digest"]).select("key", "item", "ids", "text")

    def start():
        def row(key, item, ids, text) -> Iterable[tuple]:
            a = np.frombuffer(ids, np.uint64)
            got = tiles(a, np.frombuffer(text, np.uint64), least)
            share = sum(n for n, _, _ in got) / len(a)
            return [(key, item, share, len(got), max(n for n, _, _ in got))] if share >= coverage else []

        return row

    return map_rows(ready, start, f"key {ready.dtypes[0][1]}, item {ready.dtypes[1][1]}, coverage double, n_tiles bigint, longest bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bits: int = 24) -> DataFrame:
    """(id_col, item_col, coverage, n_tiles, longest) for every contaminated pair."""
    out = judged(docs, benchmark, least, coverage, id_col, text_col, item_col, bits)
    best = out.groupBy("key.id", "item").agg(F.max(F.struct("coverage", "longest", "n_tiles")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "b.coverage", "b.n_tiles", "b.longest")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, each judged by its own text."""
    bad = judged(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("key").distinct()
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag")).alias("key")
    return docs.select(F.struct("*").alias("row"), key).join(bad, "key", "left_anti").select("row.*")
