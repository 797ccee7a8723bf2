import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from millrace.llm import chunk_bpe as C
from millrace.llm.queries import QUERIES, byte_vocabulary
from tests.llm.cases import SF, docs, empty, passage

POOL = "abc ABC\n\t\r\u0558\u208f\ua7ce\U000107bb\U0001246f\x1c\x85\xa0 ​'sllve éß日本語🙂0123!!!..  ½²Ⅷ\x00"
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def vocabulary():
    return byte_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(5)
    some = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    return [*some, "a" * 40_000, " " * 30_000, "\n" * 9_000 + "x", "ab" * 50_000, END, f"x{END}{END} y{END}", f" {END} \n" * 900, "'ll've" * 2000, "é" * 20_000, "x" + " " * 9000 + "y"]


def test_cuts_depend_on_nearby_text_only():
    a, b = passage(3000, 1).encode(), passage(3000, 2).encode()
    middle = passage(4000, 3).encode()

    def inside(head):
        return {p - len(head) for p in C.cut_places(head + middle) if p - len(head) > 2 * C.MOST}

    assert inside(a) == inside(b) == inside(b"") and len(inside(a)) > 5


def test_cuts_keep_characters_whole():
    data = ("é" * 20_000 + "日本語🙂" * 5_000).encode()
    stops = [0, *C.cut_places(data)]
    assert stops[-1] == len(data) and "".join(data[i:j].decode() for i, j in zip(stops, stops[1:])) == data.decode() and max(np.diff(stops)) <= C.MOST


@pytest.mark.parametrize("usual, least", [(1024, 64), (4, 1), (16, 2)])
def test_joined_ids_equal_the_library(vocabulary, library, monkeypatch, usual, least):
    monkeypatch.setattr(C, "USUAL", usual)
    monkeypatch.setattr(C, "LEAST", least)
    joiner = C.Joiner(vocabulary)
    for text in odd_texts():
        made = C.pieces(text, vocabulary.specials)
        known = {i: vocabulary.encoder()(text[p.start : p.stop]) for i, p in enumerate(made) if p.special is None and i % 3 == 0}
        assert joiner.ids(text, made, known) == ids(library, text)


def test_special_strings_as_plain_text(spark, vocabulary, library):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    text = f"a{END} b{END}"
    row = C.encode(docs(spark, [(1, text)]), vocabulary, specials=False).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids and row.decoded == text


def rows_of(spark):
    common = passage(900, 7)
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    rows += [(100 + i, passage(300 + i, 50 + i) + f" {common}{i} " + common[i:]) for i in range(8)] + [(None, common)] * 5 + [(200, common), (201, common * 3)]
    return rows + [(300 + i, t) for i, t in enumerate(odd_texts()[-10:])]


def test_rows_equal_the_library(spark, vocabulary, library):
    rows = rows_of(spark)
    found = C.encode(docs(spark, rows), vocabulary).collect()
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in found), key=str)
    want = sorted(((i, ids(library, t), library.decode(ids(library, t), skip_special_tokens=False)) for i, t in rows), key=str)
    assert got == want and all(d == (t or "") for (_, _, d), (_, t) in zip(sorted(got, key=lambda r: str((r[0], r[2]))), sorted(rows, key=lambda r: str((r[0], r[1] or "")))))
    assert C.encode(docs(spark, []), vocabulary).count() == 0 and empty(spark).count() == 0


def test_shared_chunks_are_owned_once(spark, vocabulary):
    common = passage(3000, 9)
    texts = docs(spark, [(i, passage(200, 30 + i) + " " + common) for i in range(20)]).select(C.text_key("text").alias("t"), "text")
    shared = spark.sparkContext.broadcast((vocabulary, {}))
    marks = [m for r in C.shared_chunks(texts, shared).collect() for m in r.marks]
    by_chunk = {}
    for m in marks:
        by_chunk.setdefault((m.h1, m.h2), []).append(m.own)
    assert len(by_chunk) > 5 and all(sum(owns) == 1 and len(owns) > 1 for owns in by_chunk.values()) and max(map(len, by_chunk.values())) == 20


def test_query_equals_the_library(spark, library):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for r in rows:
        found = ids(library, r["text"])
        want.append((r["doc_id"], len(found), sha(np.array(found, "<u4").tobytes()), sha(library.decode(found, skip_special_tokens=False).encode())))
    assert sorted(tuple(r) for r in QUERIES["op12_chunk_reuse_bpe"](spark, SF).collect()) == sorted(want)
