"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of word n-grams; texts with equal sets form one class from the start. Classes that share a band of MinHash values are candidates. A pair's values are compared a
few at a time, and the pair is dropped as soon as the posterior probability that its similarity reaches the threshold, given the matches so far and a uniform prior, falls
below ``tolerance``. The pairs that remain are verified exactly on their n-gram sets.

Pairs never become rows: the classes of a bucket are dealt to blocks of bounded size, a task compares two blocks in memory, and what leaves it is a
number of links for each class and a spanning forest of the links.

Defined cases: null, empty and wordless texts have no n-grams, link to nothing and are their own class; a text of fewer than ``n`` words is one n-gram; rows that share an id are placed by their texts, each;
rows with a null id count as documents of their class, and their class id is null where all ids of it are; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from millrace.llm.rows import hashed, map_rows, shingles, word_hashes, words
from millrace.sources.session import cut_lineage

VALUES, BAND = 96, 4
STEPS = (16, 32, 48, 64, 80, 96)
BLOCK, BLOCK_GRAMS = 512, 1_000_000


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values the fewest matches with which P(similarity >= threshold) is at least ``tolerance``."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = {}
    for n in STEPS:
        for m in range(n + 1):
            weight = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - (m * np.log(max(m, 1e-9) / n) + (n - m) * np.log(max(n - m, 1e-9) / n)))
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out[n] = m
                break
    return out


def gram_set(text: str | None, n: int, memo) -> np.ndarray:
    return np.unique(shingles(hashed(words(text), memo), n))


def class_of(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def sketches(docs: DataFrame, n: int, id_col: str, text_col: str, seed: int = 11) -> DataFrame:
    """id, text hash, class key (128 bits of the n-gram set), number of n-grams and MinHash values."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, VALUES, dtype=np.uint64)

    def start():
        memo = word_hashes()

        def row(key, tag, text) -> Iterable[tuple]:
            grams = gram_set(text, n, memo)
            if not len(grams):
                return [(key, tag, None, 0, None)]
            low = np.full(VALUES, 2**32 - 1, np.uint64)
            for at in range(0, len(grams), 1024):
                low = np.minimum(low, ((grams[at : at + 1024, None] * a + b) >> np.uint64(32)).min(0))
            return [(key, tag, class_of(grams), len(grams), low.astype("<u4").tobytes())]

        return row

    source = docs.select(id_col, F.xxhash64(text_col).alias("tag"), text_col)
    return map_rows(source, start, f"id {source.dtypes[0][1]}, tag bigint, c binary, n_grams bigint, sig binary")


def grouped(df: DataFrame, key: list[str], order: list[str], values: list[str], start: Callable[[], Callable[[list[tuple]], Iterable[tuple]]], schema: str) -> DataFrame:
    """``start()`` gives a function from the ordered rows of one key (bounded by construction) to output rows; keys arrive one after the other in sorted partitions."""
    kind = _parse_datatype_string(schema)
    dealt = df.select(*key, *order, *values).repartition(*key).sortWithinPartitions(*key, *order)
    k = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, fn, group, at, out = to_arrow_schema(kind), start(), [], None, []

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                for row in zip(*(c.to_pylist() for c in batch.slice(begin, 1024).columns), strict=True):
                    if row[:k] != at:
                        if group:
                            out.extend(fn(group))
                        group, at = [], row[:k]
                        if len(out) >= 2048:
                            yield packed(out)
                            out = []
                    group.append(row)
        if group:
            out.extend(fn(group))
        if out:
            yield packed(out)

    return dealt.mapInArrow(run, kind)


def candidates(classes: DataFrame) -> DataFrame:
    """Members of all buckets of two or more classes, dealt to pairs of blocks: u, i, j, side, c, sig, band."""
    bands = VALUES // BAND
    slices = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring(F.col("sig"), b * 4 * BAND + 1, F.lit(4 * BAND))).alias("u")))
    member = classes.select("c", "n_grams", F.explode(slices).alias("s")).select("c", "n_grams", "s.band", "s.u")
    size = member.groupBy("u").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams")).where(F.col("n") > 1)
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.least(F.col("n"), F.col("grams") / BLOCK_GRAMS))).cast("int")
    shared = member.join(size.select("u", blocks.alias("blocks")), "u").withColumn("own", F.pmod(F.hash("c"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), F.when(F.col("own") <= o, 0).otherwise(1).alias("side")))
    dealt = shared.select("c", "band", "u", F.explode(pairs).alias("p")).select("u", "p.i", "p.j", "p.side", "c", "band")
    return dealt.join(classes.select("c", "sig"), "c")


def prune(dealt: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Blocks with surviving pairs: rows of kind 0 are members (place, c), the row of kind 1 holds the pairs as places."""
    fewest = least_matches(threshold, tolerance)

    def start():
        def block(rows: list[tuple]) -> Iterable[tuple]:
            u, i, j = rows[0][:3]
            band = rows[0][6]
            sig = np.frombuffer(b"".join(r[5] for r in rows), "<u4").reshape(len(rows), VALUES)
            side = np.array([r[3] for r in rows])
            if i == j:
                a, b = np.triu_indices(len(rows), 1)
            else:
                first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                a, b = np.repeat(first, len(second)), np.tile(second, len(first))
            # A pair belongs to the first band that its two classes share.
            for k in range(band + 1):
                own = (sig[a, k * BAND : (k + 1) * BAND] == sig[b, k * BAND : (k + 1) * BAND]).all(1)
                keep = own if k == band else ~own
                a, b = a[keep], b[keep]
            matches, done = np.zeros(len(a), np.int64), 0
            for upto in STEPS:
                matches += (sig[a, done:upto] == sig[b, done:upto]).sum(1)
                keep = matches >= fewest[upto]
                a, b, matches, done = a[keep], b[keep], matches[keep], upto
            if not len(a):
                return []
            places, packed = np.unique(np.concatenate([a, b]), return_inverse=True)
            out = [(u, i, j, 0, n, rows[p][4], None) for n, p in enumerate(places.tolist())]
            return [*out, (u, i, j, 1, 0, None, packed.astype("<i4").tobytes())]

        return block

    return grouped(dealt, ["u", "i", "j"], ["side", "c"], ["sig", "band"], start, "u bigint, i int, j int, kind int, place int, c binary, pairs binary")


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[k] and b[k]."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times[gram] > 1
    owner, gram = owner[common], np.unique(gram[common], return_inverse=True)[1]
    shared, width = np.zeros((len(sets), len(sets)), np.float32), 2048
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        at, upto = np.searchsorted(gram, [low, low + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[at:upto], gram[at:upto] - low] = 1
        shared += has @ has.T
    return np.rint(shared[a, b]).astype(np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of n nodes."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        r, s = top(x), top(y)
        if r != s:
            up[max(r, s)] = min(r, s)
            out.append((x, y))
    return out


def verify(survivors: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Exact similarity of the surviving pairs. Rows: c, links (classes), docs (documents linked), other (an edge of the forest, else null)."""
    members = survivors.where("kind = 0").join(grams, "c").select("u", "i", "j", "kind", "place", "c", "size", "grams", "pairs")
    pairs = survivors.where("kind = 1").select("u", "i", "j", "kind", "place", "c", F.lit(0).cast("bigint").alias("size"), F.lit(None).cast("binary").alias("grams"), "pairs")

    def start():
        def block(rows: list[tuple]) -> Iterable[tuple]:
            *people, last = rows
            sets = [np.frombuffer(r[7], np.uint64) for r in people]
            count, weight = np.array([len(s) for s in sets]), np.array([r[6] for r in people])
            a, b = np.frombuffer(last[8], "<i4").reshape(2, -1)
            keep = np.minimum(count[a], count[b]) >= threshold * np.maximum(count[a], count[b]) - 1e-9
            a, b = a[keep], b[keep]
            if not len(a):
                return []
            both = overlaps(sets, a, b)
            keep = both >= threshold * (count[a] + count[b] - both) - 1e-9
            a, b = a[keep], b[keep]
            links = np.bincount(np.concatenate([a, b]), minlength=len(sets))
            docs = np.bincount(np.concatenate([a, b]), np.concatenate([weight[b], weight[a]]), len(sets))
            out = [(people[k][5], int(links[k]), int(docs[k]), None) for k in np.flatnonzero(links).tolist()]
            return out + [(people[x][5], 0, 0, people[y][5]) for x, y in forest(len(sets), a, b)]

        return block

    return grouped(members.unionByName(pairs), ["u", "i", "j"], ["kind", "place"], ["c", "size", "grams", "pairs"], start, "c binary, links bigint, docs bigint, other binary")


def needed_grams(docs: DataFrame, wanted: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """n-gram sets of the wanted classes (c, rep, size), each taken from the text of one of its documents, which id and text hash name: rows without an id meet only their own class."""
    rep = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag")).alias("rep")
    rows = docs.select(rep, F.col(text_col).alias("text")).join(wanted, "rep").select("c", "size", "text")

    def start():
        memo = word_hashes()

        def row(c, size, text) -> Iterable[tuple]:
            grams = gram_set(text, n, memo)
            return [(c, size, grams.tobytes())] if len(grams) and class_of(grams) == c else []

        return row

    return map_rows(rows, start, "c binary, size bigint, grams binary")


def components(edges: DataFrame) -> DataFrame:
    """(c, root) for the nodes of ``edges`` (a, b): smallest label of the neighbours, then label of the label, until nothing changes."""
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    state = cut_lineage(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("c"), F.least("a", "low").alias("root"), F.lit(True).alias("moved")), "labels")
    while not state.where("moved").isEmpty():
        near = both.join(state.select(F.col("c").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        lower = state.join(near.withColumnRenamed("a", "c"), "c").select("c", "root", F.least("root", "low").alias("next"))
        up = state.select(F.col("c").alias("next"), F.col("root").alias("jump"))
        state = cut_lineage(lower.join(up, "next").select("c", F.least("next", "jump").alias("new"), "root").select("c", F.col("new").alias("root"), (F.col("new") != F.col("root")).alias("moved")), "labels")
    return state.select("c", "root")


def representative() -> Column:
    """(id, tag) of a class's document of smallest id; of those without an id where none has one."""
    whole = F.struct("id", "tag")
    return F.coalesce(F.min(F.when(F.col("id").isNotNull(), whole)), F.min(whole))


def placed(docs: DataFrame, n: int, threshold: float, tolerance: float, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, tag (text hash), root (the group's class key, null without words), class_id, n_links, n_grams."""
    drawn = cut_lineage(sketches(docs, n, id_col, text_col), "sketches")
    classes = drawn.where(F.col("c").isNotNull()).groupBy("c").agg(F.min("id").alias("first_id"), representative().alias("rep"), F.count("*").alias("size"), F.first("n_grams").alias("n_grams"), F.first("sig").alias("sig"))
    classes = cut_lineage(classes, "classes")
    survivors = cut_lineage(prune(candidates(classes), threshold, tolerance), "survivors")
    wanted = survivors.where("kind = 0").select("c").distinct().join(classes.select("c", "rep", "size"), "c")
    grams = needed_grams(docs, wanted, n, id_col, text_col).dropDuplicates(["c"])
    checked = cut_lineage(verify(survivors, grams, threshold), "verified")
    roots = components(checked.where(F.col("other").isNotNull()).select(F.col("c").alias("a"), F.col("other").alias("b")))
    counted = checked.groupBy("c").agg(F.sum("docs").alias("docs"))
    groups = classes.select("c", "first_id", "size").join(roots, "c", "left").join(counted, "c", "left")
    groups = groups.select("c", "first_id", F.coalesce("root", "c").alias("root"), (F.col("size") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"))
    named = groups.join(groups.groupBy("root").agg(F.min("first_id").alias("class_id")), "root").select("c", "root", "class_id", "n_links")
    # Documents without words never meet a class: they are not joined, so they cannot pile up in one task.
    full = drawn.where(F.col("c").isNotNull()).select("id", "tag", "c", "n_grams").join(named, "c").select("id", "tag", "root", "class_id", "n_links", "n_grams")
    bare = drawn.where(F.col("c").isNull()).select("id", "tag", F.col("c").alias("root"), F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), "n_grams")
    return full.unionByName(bare)


def similar(docs: DataFrame, n: int = 5, threshold: float = 0.8, tolerance: float = 1e-6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, class_id (smallest id of all documents that links and equal sets connect), n_links (other documents at the threshold or over), n_grams."""
    return placed(docs, n, threshold, tolerance, id_col, text_col).select(F.col("id").alias(id_col), "class_id", "n_links", "n_grams")


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 1e-6) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every group one document whose id is the class id stays, once; rows are told apart by id and text, null ids included. Wordless rows stay, equal ones once."""
    found = placed(docs, n, threshold, tolerance, id_col, text_col).where(F.col("id").eqNullSafe(F.col("class_id")))
    # Of a group's documents that share the smallest id, or have none, that of the smallest hash.
    one = found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("tag", "id")).alias("d")).select("d.id", "d.tag")
    kept = one.union(found.where(F.col("root").isNull()).select("id", "tag")).select(F.struct("id", "tag").alias("key")).distinct()
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag")).alias("key")
    rows = docs.select(F.struct("*").alias("row"), key).join(kept, "key", "left_semi")
    same = Window.partitionBy("key").orderBy(F.lit(0))
    return rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") == 1).select("row.*")
