import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment as A
from millrace.llm.byte_level import byte_symbols
from millrace.llm.queries import QUERIES, byte_vocabulary
from tests.llm.cases import SF, docs, passage

POOL = "abc ABC\n\t\r՘꟎\x1c\x85\xa0 ​'sllve éß日本語🙂0123!!!..  ½²Ⅷ\x00"


@pytest.fixture(scope="module")
def both():
    return byte_vocabulary(), A.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(rows, libraries):
    """Token by token, with the libraries themselves."""
    a, b = libraries
    symbols = byte_symbols()
    found, held = [], defaultdict(set)
    for at, (i, text) in enumerate(rows):
        ids_a, ids_b = [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            by_a = [bytes(symbols[c] for c in a.id_to_token(t)) for t in ids_a]
            by_b = [bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode() for t in ids_b]
            if not b"".join(by_a) == b"".join(by_b) == (" " + text).encode():
                ids_a, ids_b = [], []
        groups = []
        if ids_a:
            ends_a, ends_b = np.cumsum([len(x) for x in by_a]).tolist(), np.cumsum([len(x) for x in by_b]).tolist()
            shared, start = set(ends_a) & set(ends_b), [0, 0]
            for end in sorted(shared):
                stop = [ends_a.index(end, start[0]) + 1, ends_b.index(end, start[1]) + 1]
                groups.append((ids_a[start[0] : stop[0]], ids_b[start[1] : stop[1]]))
                start = stop
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        for pair in links:
            held[pair].add(at)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((i, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    top = defaultdict(int)
    for (x, _), where in held.items():
        top[x] = max(top[x], len(where))
    out = []
    for i, n_a, n_b, n_groups, links, digest in found:
        best = sum(n for (x, y), n in links.items() if len(held[x, y]) == top[x])
        out.append((i, n_a, n_b, n_groups, sum(links.values()), best, sum(n * len(held[p]) for p, n in links.items()), digest))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def odd_rows():
    rng = random.Random(4)
    rows = [(500 + i, "".join(rng.choice(POOL) for _ in range(rng.randint(0, 400)))) for i in range(40)]
    strange = ["a" * 9000, " " * 5000, "x  y\n\n\nz", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ already", "é" * 3000, "日本語" * 900, "\x00", " ", "\n", "ｆｕｌｌ ﬁ"]
    return rows + [(600 + i, t) for i, t in enumerate(strange)] + [(700, passage(400, 5))] * 3 + [(None, "common words here")] * 9


@pytest.mark.parametrize("slab, entries, together", [(2_000_000, 6_000_000, 256), (50, 300, 3)])
def test_rows_equal_brute_force(spark, both, libraries, monkeypatch, slab, entries, together):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()] + odd_rows()
    # Tasks are forks of a worker daemon: set the limits where they are read.
    monkeypatch.setattr(A, "indexed", limited(A.indexed, slab, entries, together))
    assert got(A.align(docs(spark, rows).repartition(3), *both)) == brute(rows, libraries)
    assert A.align(docs(spark, []), *both).count() == 0


def limited(fn, slab, entries, together):
    """The same function with smaller limits in the globals that travel to the tasks."""
    import types

    space = dict(fn.__globals__)
    space |= {"SLAB": slab, "ENTRIES": entries, "TOGETHER": together}
    remade = {name: types.FunctionType(v.__code__, space, name, v.__defaults__, v.__closure__) for name, v in space.items() if isinstance(v, types.FunctionType) and v.__module__ == A.__name__}
    space |= remade
    return remade.get("indexed", fn)


def test_groups_of_many_links(both, libraries, monkeypatch):
    aligner = A.Aligner(*both)
    texts = [t for _, t in odd_rows()]
    want = aligner.align(texts)
    monkeypatch.setattr(A, "SLAB", 3)
    found = aligner.align(texts)
    assert found[0] == want[0] and found[1].tolist() == want[1].tolist() and found[2].tolist() == want[2].tolist()
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in want[0]] == [(x[1], x[2], x[3], sum(x[4].values()), x[5]) for x in plain(texts, libraries)]


def plain(texts, libraries):
    keep = []
    for t in texts:
        r = brute([(0, t)], libraries)[0]
        keep.append((0, r[1], r[2], r[3], Counter({0: r[4]}), r[7]))
    return keep


def test_postings_hold_documents_and_counts():
    rng = np.random.default_rng(1)
    keys, counts = [], []
    for pair, n in ((5, 3), (9, 4095), (11, 4096), (12, 20_000), (70, 1)):
        keys.append((pair << A.SLOT_BITS) | np.sort(rng.choice(A.DOCS, n, replace=False)))
        counts.append(rng.integers(1, 40, n) if pair != 70 else np.array([1]))
    found = {}
    for t in A.postings(np.concatenate(keys), np.concatenate(counts), 10):
        for i in range(len(t["a"])):
            slots, n = A.flat(t["bits"].slice(i, 1))
            sums = np.ones(A.DOCS, np.int64)
            for k, plane in enumerate(t["planes"][i].as_py()):
                sums[A.flat(pa.array([plane]))[0]] += 1 << k
            assert n.sum() == t["n"][i].as_py()
            found[t["a"][i].as_py() * 10 + t["b"][i].as_py()] = (slots.tolist(), sums[slots].tolist())
    assert found == {int(k[0] >> A.SLOT_BITS): ((k & (A.DOCS - 1)).tolist(), c.tolist()) for k, c in zip(keys, counts)}


def test_a_pair_that_most_documents_hold(spark, both, libraries):
    rows = [(i, f"the word {i % 7}") for i in range(5000)] + [(None, "the the the")] * 50
    assert got(A.align(docs(spark, rows, clashing=False).coalesce(1), *both)) == brute(rows, libraries)


def test_query_equals_brute_force(spark, libraries):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    assert got(QUERIES["op11_token_alignment"](spark, SF)) == brute(rows, libraries)
