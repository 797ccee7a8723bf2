import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from millrace.llm import bpe, edit_counts
from millrace.llm.queries import QUERIES, byte_codec
from tests.llm.cases import SF, docs, empty

POOL = "abc ABC\n\t\r\x1c\x85\xa0 ​'sllve éß日本語🙂0123!!!..  ½²Ⅷ\x00"


@pytest.fixture(scope="module")
def codec():
    return byte_codec()


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.find(k) for k in keys) == list(range(5000))
    assert [h.slot_of[h.find(k)] for k in keys] == list(range(5000))


def test_ids_equal_the_library(codec, library):
    rng, encode = random.Random(5), bpe.encoder(codec)
    some = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    for text in [*some, "a" * 4000, " " * 3000, "ab" * 150_000, "<|endoftext|>", "'ll've"]:
        assert ids(encode(text)) == library.encode_ordinary(text)


def test_merges_without_whole_pieces(codec, library):
    for piece in ("hello", " tokenization", "xqzjkv", "日本語", "ééé"):
        assert codec.merge(piece.encode()) == library.encode_ordinary(piece)


def test_round_trip_of_awkward_rows(spark, codec, library):
    rows = bpe.decode(bpe.encode(docs(spark), codec), codec).collect()
    texts = {(r.doc_id, r.text or "") for r in docs(spark).collect()}
    assert len(rows) == 15 and {(r.doc_id, bytes(r.decoded).decode()) for r in rows} == texts
    assert all(ids(bytes(r.ids)) == library.encode_ordinary(bytes(r.decoded).decode()) and r.n_tokens == len(ids(bytes(r.ids))) for r in rows)
    assert bpe.decode(bpe.encode(empty(spark), codec), codec).count() == 0


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op5_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def edited(text, edits):
    out, upto = [], 0
    for s, e, r in sorted(edits, key=lambda x: x[:2]):
        out += [text[upto:s], r]
        upto = e
    return "".join([*out, text[upto:]])


def test_edits_count_like_whole_texts(codec, library):
    counter, rng = edit_counts.Counter(codec), random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 120)))
        tree = counter.tree(text)
        for _ in range(3):
            cuts = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 5)))
            edits = [(a, b, "".join(rng.choice(POOL) for _ in range(rng.randint(0, 6)))) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
            new, _ = counter.edit(text, tree, edits)
            assert new == edited(text, edits)
            assert tree.total() == len(library.encode_ordinary(new)) and tree.chars[1] == len(new)
            half = [tree.tokens[2 * i] + tree.tokens[2 * i + 1] for i in range(1, tree.size)]
            assert tree.tokens[1 : tree.size] == half
            text = new


def test_a_small_edit_touches_a_small_part(codec):
    counter, text = edit_counts.Counter(codec), "some words in a row " * 20_000
    tree = counter.tree(text)
    _, redone = counter.edit(text, tree, [(200_000, 200_004, "other")])
    assert redone < 200


def test_a_small_edit_after_a_large_one_touches_a_small_part(codec, library):
    counter, text = edit_counts.Counter(codec), "some words in a row " * 200
    tree = counter.tree(text)
    text, _ = counter.edit(text, tree, [(10, 10, "and many more of them " * 2_000), (2_000, 2_010, "a few others " * 300), (3_990, 4_000, "")])
    assert tree.total() == len(library.encode_ordinary(text)) and tree.chars[1] == len(text)
    for place in range(5, len(text), 4_001):
        new, redone = counter.edit(text, tree, [(place, place + 1, "x")])
        assert redone < 200 and new == text[:place] + "x" + text[place + 1 :] and tree.total() == len(library.encode_ordinary(new))
        text = new
    kept = edit_counts.CountTree.unpacked(tree.packed())
    assert kept.size == tree.size and max(kept.chars[kept.size :]) < 200


def test_many_growing_edits_count_like_whole_texts(codec, library):
    counter, rng = edit_counts.Counter(codec), random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(1, 300)))
        tree = counter.tree(text)
        for _ in range(4):
            cuts = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 6)))
            edits = [(a, b, "".join(rng.choice(POOL) + " " for _ in range(rng.choice([0, 1, 60, 200])))) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
            text, _ = counter.edit(text, tree, edits)
            assert tree.total() == len(library.encode_ordinary(text)) and tree.chars[1] == len(text)
            assert [tree.chars[2 * i] + tree.chars[2 * i + 1] for i in range(1, tree.size)] == tree.chars[1 : tree.size]


def test_edits_of_awkward_rows(spark, codec, library):
    state = edit_counts.build(docs(spark), codec)
    out = edit_counts.apply_edits(edit_counts.build(docs(spark), codec, edits_of=edit_counts.cleaning_edits), codec).collect()
    assert len(out) == 15 and all(r.n_tokens == len(library.encode_ordinary(r.text)) for r in out)
    none = edit_counts.apply_edits(state.selectExpr("*", "cast(null as array<struct<start:int,stop:int,new:string>>) as edits"), codec).collect()
    assert all(r.n_tokens == r.n_before and r.n_redone == 0 for r in none)
    beyond = edit_counts.apply_edits(state.selectExpr("*", "array(named_struct('start', -5, 'stop', 1000000, 'new', 'all new')) as edits"), codec).collect()
    assert {r.text for r in beyond} == {"all new"}
    assert edit_counts.build(empty(spark), codec).count() == 0
    with pytest.raises(ValueError):
        edit_counts.Counter(codec).edit("abcdef", edit_counts.Counter(codec).tree("abcdef"), [(0, 3, ""), (2, 4, "")])


def test_edit_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op2_edit_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        new = edited(texts[r.doc_id], list(edit_counts.cleaning_edits(texts[r.doc_id])))
        assert (r.n_tokens_before, r.n_tokens_after) == (len(library.encode_ordinary(texts[r.doc_id])), len(library.encode_ordinary(new)))
        assert r.text_sha256 == hashlib.sha256(new.encode()).hexdigest()
