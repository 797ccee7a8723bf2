"""BPE encoding by content-defined chunks: a chunk that several places share is encoded once, and chunk joins are repaired.

Texts are cut where a rolling hash of the last 32 bytes has a given remainder, so equal passages give equal chunks wherever they stand. A chunk is encoded on its
own. Where two chunks meet, the split into pre-tokens may differ from that of the whole text: the repair goes back to the last place in the left chunk where any
split has to end (white space after something else) and splits on from there, beside the split of the right chunk on its own, until both end at the same place;
only the stretch between is encoded again. From that place on both splits see the same text and stay equal, so the ids are those of the whole text.

What moves:

1. A row of hashes for each chunk: a chunk is shared when two places hold it, and the place of smallest hash owns it.
2. Every distinct text once, compressed, to the marks of its shared chunks. Texts without chunks owned elsewhere are finished there; the others are put aside, and
   the chunks that a text owns are encoded.
3. Encoded chunks to the texts that were put aside, which encode nothing but their own chunks and the joins.

A chunk, text or id that a third of all rows hold is spread over ``SPREAD`` groups in every join.

Defined cases: a null or empty text has no ids; the vocabulary's special strings inside a text become their ids (``specials=True``) or plain text; long texts are
cut like others, runs without a cut after ``MOST`` bytes; rows with equal ids or texts give a row each; null ids are kept; an empty table gives no rows; other
columns stay out of the way, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_level import Vocabulary
from millrace.llm.rows import map_rows
from millrace.sources.session import cut_lineage

WINDOW = 32
LEAST, USUAL, MOST = 64, 1024, 8192
SPREAD = 64
#: A place between white space and what is before it ends a pre-token of every split.
EDGE = regex.compile(r"(?r)(?<=\S)(?=\s)")
GEAR = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)


@dataclass
class Piece:
    """A chunk (with its hash) or a special string (with its id) of a text, by character positions."""

    start: int
    stop: int
    hash: int | None = None
    special: int | None = None


def rolling(data: np.ndarray) -> np.ndarray:
    """For every byte the hash of it and the 31 before it, by doubling the window."""
    sums, width = GEAR[data], 1
    while width < WINDOW and width < len(sums):
        wider = sums.copy()
        wider[width:] += sums[:-width] << np.uint64(width)
        sums, width = wider, width * 2
    return sums


def cut_places(data: bytes) -> list[int]:
    """Byte positions where chunks end, between characters; the end of the data is the last."""
    array = np.frombuffer(data, np.uint8)
    # The upper half of the hash holds all 32 bytes.
    places = np.flatnonzero((rolling(array) >> np.uint64(40)) % np.uint64(USUAL) == 0) + 1
    places = places[places < len(array)]
    places = places[(array[places] & 0xC0) != 0x80]
    out, at, n = [], 0, len(array)
    while at < n:
        i = int(np.searchsorted(places, at + LEAST))
        stop = int(places[i]) if i < len(places) else n
        if stop - at > MOST:
            stop = at + MOST
            while data[stop] & 0xC0 == 0x80:
                stop -= 1
        out.append(stop)
        at = stop
    return out


def pieces(text: str, specials: dict[str, int]) -> list[Piece]:
    parts = re.split("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")", text) if specials else [text]
    out, at = [], 0
    for i, part in enumerate(parts):
        if i % 2:
            out.append(Piece(at, at + len(part), special=specials[part]))
        elif part:
            data = part.encode()
            plain, before, begin = len(data) == len(part), 0, at
            for stop in cut_places(data):
                n = stop - before if plain else len(data[before:stop].decode())
                out.append(Piece(begin, begin + n, hash=xxhash.xxh3_128_intdigest(data[before:stop])))
                before, begin = stop, begin + n
        at += len(part)
    return out


class Joiner:
    """Puts the ids of a text's pieces together as those of the whole text."""

    def __init__(self, vocabulary: Vocabulary):
        self.encode, self.lengths = vocabulary.encoder(), vocabulary.lengths.tolist()
        self.split = regex.compile(vocabulary.pattern).match

    def ids(self, text: str, made: list[Piece], known: dict[int, list[int]]) -> list[int]:
        """``known`` gives ids of pieces by their number; the others are encoded here."""
        out: list[int] = []
        i = 0
        while i < len(made):
            if made[i].special is not None:
                out.append(made[i].special)
                i += 1
                continue
            stop = i
            while stop < len(made) and made[stop].special is None:
                stop += 1
            self.run(text, made, i, stop, known, out)
            i = stop
        return out

    def run(self, text: str, made: list[Piece], i: int, stop: int, known: dict[int, list[int]], out: list[int]) -> None:
        """Chunks i..stop-1, which follow each other without a special string."""
        end, agreed = made[stop - 1].stop, made[i].start
        while i < stop:
            mine = known[i] if i in known else self.encode(text[made[i].start : made[i].stop])
            out.extend(mine[self.count(mine, text[made[i].start : agreed]) :])
            edge = made[i].stop
            if edge == end:
                return
            found = EDGE.search(text, agreed, edge + 1)
            back = found.start() if found else agreed
            self.drop(out, text[back:edge])
            i, agreed = self.agreement(text, made, i + 1, stop, back, out)
            if agreed == end:
                return

    def agreement(self, text: str, made: list[Piece], j: int, stop: int, whole: int, out: list[int]) -> tuple[int, int]:
        """The first place at or after chunk j where the split of the whole text, going on from ``whole``, and that of a chunk alone both end; and the chunk.

        Pre-tokens up to there are encoded one by one: white space at the end of a stretch would be split otherwise than before more text.
        """
        end, alone = made[stop - 1].stop, made[j].start
        while whole != alone:
            if whole < alone:
                before, whole = whole, self.split(text, whole, end).end()
                out.extend(self.encode(text[before:whole]))
            elif alone == made[j].stop:
                j += 1
            else:
                alone = self.split(text, alone, made[j].stop).end()
        return j, whole

    def count(self, ids: list[int], head: str) -> int:
        """How many ids make up a text that they begin with."""
        left, n = len(head.encode()), 0
        while left > 0:
            left -= self.lengths[ids[n]]
            n += 1
        assert left == 0
        return n

    def drop(self, ids: list[int], tail: str) -> None:
        left = len(tail.encode())
        while left > 0:
            left -= self.lengths[ids.pop()]
        assert left == 0


Outputs = Callable[[str, list[int]], tuple]


def whole_results(vocabulary: Vocabulary) -> tuple[str, Callable[[Vocabulary], Outputs]]:
    """Default results: the ids as little-endian 32-bit integers, and the text they decode to."""

    def start(v: Vocabulary) -> Outputs:
        return lambda text, ids: (np.array(ids, "<u4").tobytes(), decoded(v, ids).decode("utf-8", "replace"))

    return "ids binary, decoded string", start


def decoded(vocabulary: Vocabulary, ids: Iterable[int]) -> bytes:
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids))


def signed(h: int) -> tuple[int, int]:
    low, high = h & (2**64 - 1), h >> 64
    return low - 2**64 if low >= 2**63 else low, high - 2**64 if high >= 2**63 else high


def text_key(col: str) -> Column:
    return F.unhex(F.md5(F.encode(F.coalesce(F.col(col), F.lit("")), "UTF-8")))


def spread_over(rows: DataFrame, facts: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """Join of rows, spread by their column ``part``, with one fact row a key: facts go to those parts that have the key."""
    parts = rows.select(*key, "part").distinct().join(facts, key)
    return rows.join(parts, [*key, "part"], how)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, specials: bool = True, id_col: str = "doc_id", text_col: str = "text",
    results: tuple[str, Callable[[Vocabulary], Outputs]] | None = None,
) -> DataFrame:
    """id, ``n_tokens`` and the results of every row: by default ``ids`` and ``decoded``.

    ``results`` is a schema and a function that is called once a task and makes, of a text and its ids, the values of those columns; with digests in place of
    ids, less is moved from distinct texts to rows.
    """
    schema, make = results or whole_results(vocabulary)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, vocabulary.specials if specials else {}))
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = keyed.select("t", "text")

    marks = cut_lineage(shared_chunks(texts, shared), "marks")
    packed = map_rows(texts, lambda: packer(), "t binary, z binary").dropDuplicates(["t"])

    def first_pass():
        vocabulary, specials = shared.value
        joiner, out, unpack = Joiner(vocabulary), make(vocabulary), zstandard.ZstdDecompressor().decompress
        kind = id_type(vocabulary)

        def row(t, z, marked) -> Iterable[tuple]:
            text = unpack(z).decode()
            made = pieces(text, specials)
            known = {m["pos"]: joiner.encode(text[made[m["pos"]].start : made[m["pos"]].stop]) for m in marked or [] if m["own"]}
            nothing = (None,) * width
            for pos, ids in known.items():
                yield ("chunk", None, *signed(made[pos].hash), np.array(ids, kind).tobytes(), None, *nothing)
            if all(m["own"] for m in marked or []):
                ids = joiner.ids(text, made, known)
                yield ("done", t, None, None, None, len(ids), *out(text, ids))
            else:
                yield ("open", t, None, None, z, None, *nothing)

        return row

    width = len(docs.sparkSession.createDataFrame([], schema).columns)
    both = packed.join(marks.select("t", F.transform("marks", lambda m: F.struct(m["pos"].alias("pos"), m["own"].alias("own"))).alias("marked")), "t", "left")
    stage = cut_lineage(map_rows(both, first_pass, f"kind string, t binary, h1 bigint, h2 bigint, data binary, n_tokens bigint, {schema}"), "chunks")
    columns = stage.columns[5:]

    chunks = stage.where("kind = 'chunk'").select("h1", "h2", "data")
    wanted = marks.where(F.exists("marks", lambda m: ~m["own"])).select("t", F.inline("marks")).select("t", "pos", "h1", "h2", part_of("t").alias("part"))
    filled = spread_over(wanted, chunks, ["h1", "h2"]).groupBy("t").agg(F.collect_list(F.struct("pos", "data")).alias("filled"))

    def second_pass():
        vocabulary, specials = shared.value
        joiner, out, unpack = Joiner(vocabulary), make(vocabulary), zstandard.ZstdDecompressor().decompress
        kind = id_type(vocabulary)

        def row(t, z, filled) -> Iterable[tuple]:
            text = unpack(z).decode()
            ids = joiner.ids(text, pieces(text, specials), {f["pos"]: np.frombuffer(f["data"], kind).tolist() for f in filled})
            return [(t, len(ids), *out(text, ids))]

        return row

    late = stage.where("kind = 'open'").select("t", "data").join(filled, "t")
    finished = stage.where("kind = 'done'").select("t", *columns).union(map_rows(late, second_pass, f"t binary, n_tokens bigint, {schema}"))
    members = keyed.groupBy("id", "t").agg(F.count(F.lit(1)).alias("copies")).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SPREAD)))
    rows = spread_over(members, finished, ["t"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(F.col("id").alias(id_col), *columns)


def part_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SPREAD))


def id_type(vocabulary: Vocabulary) -> str:
    return "<u2" if vocabulary.size <= 2**16 else "<u4"


def packer():
    pack = zstandard.ZstdCompressor(level=3).compress
    return lambda t, text: [(t, pack(text.encode()))]


def shared_chunks(texts: DataFrame, shared) -> DataFrame:
    """For every text with chunks that two places or more hold: ``marks`` of their numbers, hashes, and whether this place owns them."""

    def start():
        specials = shared.value[1]

        def row(t, text) -> Iterable[tuple]:
            return [(t, pos, *signed(p.hash), xxhash.xxh3_64_intdigest(t + pos.to_bytes(8, "little")) - 2**63) for pos, p in enumerate(pieces(text, specials)) if p.special is None]

        return row

    places = map_rows(texts, start, "t binary, pos int, h1 bigint, h2 bigint, place bigint").withColumn("part", part_of("t"))
    by_part = places.groupBy("h1", "h2", "part").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    owners = by_part.groupBy("h1", "h2").agg(F.min("low").alias("owner"), F.max("high").alias("last")).where("owner < last").drop("last")
    held = by_part.select("h1", "h2", "part").join(owners, ["h1", "h2"])
    marked = places.join(held, ["h1", "h2", "part"]).select("t", F.struct("pos", "h1", "h2", (F.col("place") == F.col("owner")).alias("own")).alias("m"))
    return marked.groupBy("t").agg(F.collect_set("m").alias("marks"))
