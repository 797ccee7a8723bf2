"""Alignment of two tokenizers over the same bytes, with the corpus-wide document counts of their id pairs from inverted pair bitmaps.

A text is encoded by a byte-level vocabulary (A) and a sentencepiece model (B). Byte offsets where tokens of both end cut the tokens into groups; an A token and a B token
of one group are linked. The index holds, for each id pair and block of at most 65,536 documents, a compressed bitmap of the documents that link the pair (sorted
16-bit numbers, or 8 KB of bits from 4,096 documents on), and a stack of planes: plane k has the documents whose link count less one has bit k.

1. One pass over the texts writes a row for each document and the index of its block. Within a block, bitmaps of a pair are OR-merged as batches of documents come in.
   Blocks share no documents, so the OR of a pair's bitmaps over all blocks is their concatenation and its popcount is the sum of theirs.
2. Pair counts are summed over blocks (one row a pair and block, added up before they are shuffled), and the highest count of each A id is found.
3. Counts go back to the blocks that hold the pair; there the postings hand every document its links, weighted by the planes.

A pair that all documents link is one row a block at every step; the pairs inside a document are never rows of their own.

Defined cases: texts that are null, empty, or whose bytes by A or B differ from a space and the text, have no tokens: zeros and the digest ''. Special strings are plain
text. Very long texts are worked off in slabs of groups. Rows with equal ids or texts count each as a document; null ids are kept; an empty table gives no rows;
other columns stay out of the way, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.byte_level import Vocabulary
from millrace.sources.session import cut_lineage

#: Documents and (document, pair) entries of a block, links of a slab, documents and characters that are aligned together.
DOCS, ENTRIES, SLAB, TOGETHER, CHARS = 2**16, 6_000_000, 2_000_000, 256, 1_000_000
DENSE = 4096
SLOT_BITS = 16


class Pieces:
    """A sentencepiece model: encoding, and the bytes of every piece."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = model
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)

    def __reduce__(self):
        return Pieces, (self.model,)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


def read_pieces(path: str) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


class Aligner:
    def __init__(self, a: Vocabulary, b: Pieces):
        self.a, self.b, self.encode = a, b, a.encoder()
        self.n_b = len(b.bytes_of)
        # Ids as text, with what may follow them: [A then ",", A then "|", B then ",", B then ";"].
        ends = [[f"{i}{mark}".encode() for i in range(n)] for n, marks in ((a.size, ",|"), (self.n_b, ",;")) for mark in marks]
        self.words, self.word_at = sum(ends, []), np.cumsum([0, *map(len, ends)])[:4]

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        out = []
        for text, pieces in zip(texts, self.b.encode([t or "" for t in texts]), strict=True):
            if not text or b"".join(map(self.b.bytes_of.__getitem__, pieces)) != b" " + text.encode():
                out.append(([], []))
            else:
                out.append((self.encode(" " + text), pieces))
        return out

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """For each text (n_a, n_b, n_groups, n_links, digest); and the pairs of all, as keys (pair, text number) with link counts, in order of the keys."""
        both = self.tokens(texts)
        a = np.fromiter((i for ids, _ in both for i in ids), np.int64)
        b = np.fromiter((i for _, ids in both for i in ids), np.int64)
        stop_a, stop_b = np.cumsum([len(x) for x, _ in both]), np.cumsum([len(x) for _, x in both])
        at_a, at_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        total = int(at_a[-1]) + 1 if len(a) else 1
        ends = np.zeros(total, np.uint8)
        ends[at_a] = 1
        ends[at_b] += 1
        last_a, last_b = ends[at_a] == 2, ends[at_b] == 2
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_groups = int(last_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        links = np.concatenate(([0], np.cumsum(in_a * in_b)))
        groups = np.concatenate(([0], np.cumsum(last_a)))[stop_a]  # groups up to the end of each text

        # All tokens in the order of the digest: a group's A ids, then its B ids.
        before_b, through_a = np.concatenate(([0], np.cumsum(in_b))), np.cumsum(in_a)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = a + self.word_at[last_a.astype(np.int64)]
        order[np.arange(len(b)) + through_a[group_b] if len(b) else []] = b + self.word_at[2 + last_b.astype(np.int64)]
        rows, words = [], self.words
        start = 0
        done_a = done_b = done_groups = 0
        for x, y, g in zip(stop_a.tolist(), stop_b.tolist(), groups.tolist(), strict=True):
            digest = ""
            if x > done_a:
                said = hashlib.sha256()
                for at in range(start, x + y, SLAB):
                    some = b"".join(map(words.__getitem__, order[at : min(at + SLAB, x + y)].tolist()))
                    said.update(some if at + SLAB < x + y else some[:-1])
                digest = said.hexdigest()
            rows.append((x - done_a, y - done_b, g - done_groups, int(links[g] - links[done_groups]), digest))
            start, done_a, done_b, done_groups = x + y, x, y, g

        text_of = np.searchsorted(groups, np.arange(n_groups), "right")
        first_a, first_b = np.concatenate(([0], np.cumsum(in_a))), before_b
        parts = []
        g = 0
        while g < n_groups:
            stop = max(g + 1, int(np.searchsorted(links, links[g] + SLAB, "right")) - 1)
            mine_a, mine_b = a[first_a[g] : first_a[stop]], b[first_b[g] : first_b[stop]]
            if stop == g + 1 and links[stop] - links[g] > SLAB:  # one group of many links: count ids before they are paired
                (ids_a, n_a), (ids_b, n_b) = np.unique(mine_a, return_counts=True), np.unique(mine_b, return_counts=True)
                pair, n = (ids_a[:, None] * self.n_b + ids_b).ravel(), (n_a[:, None] * n_b).ravel()
                parts.append((pair << SLOT_BITS | text_of[g], n))
            else:
                of = group_a[first_a[g] : first_a[stop]]
                times = in_b[of]
                begins = np.cumsum(times) - times
                partner = np.arange(int(times.sum())) + np.repeat(first_b[of] - first_b[g] - begins, times)
                pair = np.repeat(mine_a, times) * self.n_b + mine_b[partner]
                parts.append(np.unique(pair << SLOT_BITS | np.repeat(text_of[of], times), return_counts=True))
            g = stop
        return rows, *merged(parts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Union of the entries, counts of equal keys added up."""
    if len(parts) == 1:
        return parts[0]
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.int64)
    counts = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def container(slots: np.ndarray) -> bytes:
    """Sorted 16-bit numbers, or one bit for each of 65,536; 8 KB always means bits."""
    if len(slots) < DENSE:
        return slots.astype("<u2").tobytes()
    flags = np.zeros(DOCS, np.uint8)
    flags[slots] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def binaries(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values of the given numbers of 16-bit items, one after another in ``data``."""
    offsets = np.concatenate(([0], np.cumsum(lengths * 2))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data, "<u2"))])


def postings(keys: np.ndarray, counts: np.ndarray, n_b: int) -> Iterator[dict[str, pa.Array]]:
    """The index of a block from its entries, in order of pair and document: ``a``, ``b``, ``n`` (documents), ``bits``, ``planes``."""
    if not len(keys):
        return
    pair, slot, more = keys >> SLOT_BITS, keys & (DOCS - 1), counts - 1
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    n = np.diff(np.r_[first, len(pair)])
    many = n >= DENSE
    row = np.repeat(np.arange(len(first)), n)
    few = ~many[row]
    if few.any():
        kept = np.flatnonzero(~many)
        number = np.cumsum(~many) - 1  # of each pair among those kept
        row_few, more_few, slot_few = number[row[few]], more[few], slot[few]
        depth = int(more_few.max()).bit_length()
        highest = np.maximum.reduceat(more_few, np.cumsum(n[kept]) - n[kept])
        planes = np.zeros(len(kept), np.int64)
        sizes = np.zeros((len(kept), depth), np.int64)
        at, items = [], []
        for k in range(depth):
            planes += highest >> k > 0
            has = np.flatnonzero(more_few >> k & 1)
            sizes[:, k] = np.bincount(row_few[has], minlength=len(kept))
            at.append(row_few[has] * depth + k)
            items.append(slot_few[has])
        order = np.argsort(np.concatenate(at), kind="stable") if at else []
        used = np.arange(depth) < planes[:, None]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(planes))), pa.int32()), binaries(sizes[used], np.concatenate(items)[order] if items else np.zeros(0)))
        yield columns(pair[first[kept]], n_b, n[kept], binaries(n[kept], slot_few), lists)
    for i in np.flatnonzero(many).tolist():
        mine, extra = slot[first[i] : first[i] + n[i]], more[first[i] : first[i] + n[i]]
        planes = [container(mine[extra >> k & 1 == 1]) for k in range(int(extra.max()).bit_length())]
        yield columns(pair[first[i] : first[i] + 1], n_b, n[i : i + 1], pa.array([container(mine)], pa.binary()), pa.array([planes], pa.list_(pa.binary())))


def columns(pair: np.ndarray, n_b: int, n: np.ndarray, bits: pa.Array, planes: pa.Array) -> dict[str, pa.Array]:
    return {"a": pa.array(pair // n_b, pa.int32()), "b": pa.array(pair % n_b, pa.int32()), "n": pa.array(n, pa.int64()), "bits": bits, "planes": planes}


def batches_of(table: dict[str, pa.Array], schema: pa.Schema, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(table.values())))
    whole = pa.RecordBatch.from_arrays([table[f.name] if f.name in table else pa.nulls(n, f.type) for f in schema], schema=schema)
    for at in range(0, n, rows):
        yield whole.slice(at, rows)


def indexed(docs: DataFrame, a: Vocabulary, b: Pieces) -> DataFrame:
    """Rows of documents (``slot`` not null) and of postings (``a`` not null), both with their ``block``."""
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    id_type = docs.schema["id"].dataType
    facts = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
    schema = pa.schema([("block", pa.int64()), ("slot", pa.int32()), ("id", to_arrow_type(id_type)), *facts,
                        ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("bits", pa.binary()), ("planes", pa.list_(pa.binary()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        block, size, slots, parts = TaskContext.get().partitionId() << 32, 0, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            for table in postings(*merged(parts), aligner.n_b):
                table["block"] = pa.array(np.full(len(table["a"]), block))
                yield from batches_of(table, schema)

        for ids, texts in together(source):
            rows, keys, counts = aligner.align(texts)
            if slots + len(texts) > DOCS or size + len(keys) > ENTRIES and size:
                yield from flush()
                block, size, slots, parts = block + 1, 0, 0, []
            table = {name: pa.array(v, t) for (name, t), v in zip(facts, zip(*rows, strict=True), strict=True)}
            table |= {"id": ids, "slot": pa.array(range(slots, slots + len(texts)), pa.int32()), "block": pa.array([block] * len(texts), pa.int64())}
            yield from batches_of(table, schema)
            parts.append((keys + slots, counts.astype(np.int32)))
            size, slots = size + len(keys), slots + len(texts)
        yield from flush()

    kinds = "block bigint, slot int, id {}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, a int, b int, n bigint, bits binary, planes array<binary>"
    return docs.select("id", "text").mapInArrow(run, kinds.format(id_type.simpleString()))


def together(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """A few documents at a time, by number and by length."""
    for batch in source:
        at = 0
        while at < batch.num_rows:
            texts, chars, stop = [], 0, at
            while stop < batch.num_rows and len(texts) < TOGETHER and chars < CHARS:
                texts.append(batch.column(1)[stop].as_py())
                chars, stop = chars + len(texts[-1] or ""), stop + 1
            yield batch.column(0).slice(at, stop - at), texts
            at = stop


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all containers, one after another, and how many each has."""
    values = values.cast(pa.binary()) if values.type != pa.binary() else values
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    wide = np.flatnonzero(lengths == DOCS // 8)
    if not len(wide):
        return data[offsets[0] : offsets[-1]].view("<u2") if len(values) else np.zeros(0, np.uint16), lengths // 2
    parts, counts, at = [], lengths // 2, 0
    for i in wide.tolist():
        parts.append(data[offsets[at] : offsets[i]].view("<u2"))
        parts.append(np.flatnonzero(np.unpackbits(data[offsets[i] : offsets[i + 1]], bitorder="little")).astype(np.uint16))
        counts[i], at = len(parts[-1]), i + 1
    return np.concatenate([*parts, data[offsets[at] : offsets[-1]].view("<u2")]), counts


def scored(postings: DataFrame) -> DataFrame:
    """Sums of each document's links from the postings of its block, which come one block after another: ``block``, ``slot``, ``n_best``, ``count_sum``."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, sums = None, np.zeros(DOCS, np.int64), np.zeros(DOCS, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            slots = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), block), pa.int64()), pa.array(slots, pa.int32()), pa.array(best[slots]), pa.array(sums[slots])], names=["block", "slot", "n_best", "count_sum"]
            )

        for batch in source:
            blocks = batch.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]).tolist()
            for start, stop in zip(edges, [*edges[1:], len(blocks)], strict=True):
                if blocks[start] != block:
                    if block is not None:
                        yield from flush()
                    block, best, sums = int(blocks[start]), np.zeros(DOCS, np.int64), np.zeros(DOCS, np.int64)
                part = batch.slice(start, stop - start)
                count, top = part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
                slots, n = flat(part.column("bits"))
                np.add.at(sums, slots, np.repeat(count, n))
                np.add.at(best, slots, np.repeat(top, n))
                planes = part.column("planes")
                depths = np.diff(planes.offsets.to_numpy())
                owner = np.repeat(np.arange(len(depths)), depths)
                weight = 1 << (np.arange(len(owner)) - np.repeat(np.cumsum(depths) - depths, depths))
                slots, n = flat(planes.flatten())
                np.add.at(sums, slots, np.repeat(count[owner] * weight, n))
                np.add.at(best, slots, np.repeat(top[owner] * weight, n))
        if block is not None:
            yield from flush()

    return postings.select("block", "bits", "planes", "count", "best").mapInArrow(run, "block bigint, slot int, n_best bigint, count_sum bigint")


def pair_counts(postings: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (documents that hold the pair linked) and ``best`` (no pair of this A id has more)."""
    counts = postings.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def align(docs: DataFrame, a: Vocabulary, b: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row."""
    found = cut_lineage(indexed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), a, b), "pair-index")
    index = found.where("a is not null").select("block", "a", "b", "n", "bits", "planes")
    counted = index.select("block", "a", "b").join(pair_counts(index), ["a", "b"])
    links = index.drop("n").join(counted, ["block", "a", "b"])
    sums = scored(links.repartition("block").sortWithinPartitions("block"))
    rows = found.where("slot is not null").select("block", "slot", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, ["block", "slot"], "left")
    zero = [F.coalesce(x, F.lit(0)).alias(x) for x in ("n_best", "count_sum")]
    return rows.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
