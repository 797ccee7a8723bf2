"""Token counts that follow edits.

A document's state is its text and a segment tree over its pre-tokens: a leaf stands for a few neighbouring pre-tokens and holds their characters and tokens, an inner node the sums
of its children. Edits re-split and re-encode only from the leaf that holds the two characters before them (no pre-token looks further ahead) to the first leaf boundary after them where the
new split falls in step with the old one; what was encoded is dealt over the touched leaves and the sums above them are updated. Where that would put more than two leaves' worth into one, the tree gets
more leaves, once for all edits of a call. What comes out equals counting the whole edited text.

Defined cases: a null text counts as empty; edits outside the text are cut to it; edits must not overlap and are taken in order of their start, insertions at one place in the order given;
null or no edits leave a document as it is; repeated rows are counted each; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame

from millrace.llm.bpe import Codec
from millrace.llm.rows import Memo, map_rows

LEAF = 8
LOOK_AHEAD = 2


def sums_of(leaves: np.ndarray) -> np.ndarray:
    """The tree over ``leaves``, level by level."""
    size = 1
    while size < len(leaves):
        size *= 2
    tree = np.zeros(2 * size, np.int64)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        tree[size // 2 : size] = tree[size : 2 * size : 2] + tree[size + 1 : 2 * size : 2]
        size //= 2
    return tree


class CountTree:
    """Sums of characters and tokens in heap order: node i has children 2i and 2i + 1, leaves begin at ``size``."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens, self.size = chars, tokens, len(chars) // 2

    @classmethod
    def unpacked(cls, data: bytes) -> CountTree:
        chars, tokens = np.frombuffer(data, "<i4").reshape(2, -1)
        return cls(chars.tolist(), tokens.tolist())

    def packed(self) -> bytes:
        return np.array([self.chars, self.tokens], "<i4").tobytes()

    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last leaf with characters, if it is beyond the end), and where the leaf starts."""
        place, start, node = min(place, self.chars[1] - 1), 0, 1
        if place < 0:
            return 0, 0
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.size + leaf
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node and (more_chars or more_tokens):
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def split(self, full: dict[int, np.ndarray]) -> None:
        """Builds the tree anew with the leaves in ``full`` (characters and tokens of their pre-tokens) cut into leaves of LEAF; empty leaves go."""
        old = np.array([self.chars[self.size :], self.tokens[self.size :]], np.int64)
        parts, upto = [], 0
        for leaf, pieces in sorted(full.items()):
            parts += [old[:, upto:leaf], np.add.reduceat(pieces, np.arange(0, pieces.shape[1], LEAF), axis=1)]
            upto = leaf + 1
        leaves = np.concatenate([*parts, old[:, upto:]], axis=1)
        chars, tokens = leaves[:, leaves[0] > 0]
        self.__init__(sums_of(chars).tolist(), sums_of(tokens).tolist())


class Counter:
    def __init__(self, codec: Codec):
        self.split = regex.compile(codec.pattern)
        # A pre-token by itself is split into nothing smaller, so the library's count of it is its count in the text.
        library = tiktoken.Encoding("counts", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})
        self.tokens_of = Memo(lambda piece: 1 if piece.encode() in codec.ranks else len(library.encode_ordinary(piece)))

    def sums(self, text: str) -> np.ndarray:
        """Two rows: the trees of characters and of tokens. Leaves take LEAF pre-tokens each; the pattern leaves no character out."""
        pieces = self.split.findall(text)
        at = np.arange(0, len(pieces), LEAF)
        if not pieces:
            return np.zeros((2, 2), np.int64)
        each = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(map(self.tokens_of.__getitem__, pieces), np.int64, len(pieces))
        return np.stack([sums_of(np.add.reduceat(x, at)) for x in each])

    def tree(self, text: str) -> CountTree:
        return CountTree(*self.sums(text).tolist())

    def edit(self, text: str, tree: CountTree, edits: list[tuple[int, int, str]]) -> tuple[str, int]:
        """Applies the edits (start, stop, new text) to the tree; returns the new text and how many characters were encoded again."""
        edits, n, upto = sorted(((max(0, s), max(0, s, e), r) for s, e, r in edits), key=lambda x: x[:2]), len(text), 0
        parts, fixed = [], []
        for s, e, r in edits:
            s, e = min(s, n), min(e, n)
            if s < upto:
                raise ValueError("edits overlap")
            parts += [text[upto:s], r]
            fixed.append((s, e, len(r)))
            upto = e
        new = "".join([*parts, text[upto:]])
        if not text:
            fresh = self.tree(new)
            tree.__init__(fresh.chars, fresh.tokens)
            return new, len(new)
        i, shift, redone = 0, 0, 0
        full: dict[int, np.ndarray] = {}  # pre-tokens of leaves that got more than two leaves' worth
        while i < len(fixed):
            # The tree is in new places up to here, so old places plus the shift so far are places in it.
            left, begin = tree.leaf_at(max(0, fixed[i][0] + shift - LOOK_AHEAD))
            last, upto, at = left, begin + tree.chars[tree.size + left], begin  # ``last`` ends at ``upto`` before the shift of this region
            region: list[tuple[int, int]] = []
            delta, stop = 0, -1
            while i < len(fixed) and fixed[i][0] + shift - LOOK_AHEAD < upto:
                delta, stop, i = delta + fixed[i][2] - (fixed[i][1] - fixed[i][0]), fixed[i][1] + shift, i + 1
            for m in self.split.finditer(new, begin):
                at = m.end()
                region.append((m.end() - m.start(), self.tokens_of[m.group()]))
                while True:
                    while last + 1 < tree.size and (upto < stop or upto + delta < at):
                        last += 1
                        upto += tree.chars[tree.size + last]
                    if i < len(fixed) and fixed[i][0] + shift - LOOK_AHEAD < upto:
                        delta, stop, i = delta + fixed[i][2] - (fixed[i][1] - fixed[i][0]), fixed[i][1] + shift, i + 1
                    else:
                        break
                if upto >= stop and upto + delta == at:
                    break
            else:
                at, last = len(new), tree.size - 1
                i = len(fixed)
            leaves = last + 1 - left
            each = max(LEAF, -(-len(region) // leaves))
            if each > 2 * LEAF:
                full[left], each = np.array(region, np.int64).T, len(region)
            for leaf in range(leaves):
                part = region[leaf * each : (leaf + 1) * each]
                tree.put(left + leaf, sum(c for c, _ in part), sum(n for _, n in part))
            redone += at - begin
            shift += delta
        if full:
            tree.split(full)
        return new, redone


EDITS = "array<struct<start:int,stop:int,new:string>>"


def build(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text", edits_of: Callable[[str], Iterable[tuple[int, int, str]]] | None = None) -> DataFrame:
    """State of every document: id_col, text, n_tokens, tree; and ``edits``, where ``edits_of`` names the edits of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def start():
        counter = Counter(shared.value)

        def row(key, text) -> Iterable[tuple]:
            text = text or ""
            sums = counter.sums(text)
            state = (key, text, int(sums[1, 1]), sums.astype("<i4").tobytes())
            return [state if edits_of is None else (*state, [{"start": s, "stop": e, "new": r} for s, e, r in edits_of(text)])]

        return row

    source = docs.select(id_col, text_col)
    schema = f"`{id_col}` {source.dtypes[0][1]}, text string, n_tokens bigint, tree binary"
    return map_rows(source, start, schema if edits_of is None else f"{schema}, edits {EDITS}")


def apply_edits(state: DataFrame, codec: Codec, id_col: str = "doc_id", edits_col: str = "edits") -> DataFrame:
    """The state after the edits of each row (EDITS, in characters of its text), with tokens before and characters encoded again."""
    shared = state.sparkSession.sparkContext.broadcast(codec)

    def start():
        counter = Counter(shared.value)

        def row(key, text, n_tokens, tree, edits) -> Iterable[tuple]:
            if not edits:
                return [(key, text, n_tokens, tree, n_tokens, 0, 0)]
            sums = CountTree.unpacked(tree)
            new, redone = counter.edit(text, sums, [(e["start"], e["stop"], e["new"]) for e in edits])
            return [(key, new, sums.total(), sums.packed(), n_tokens, len(edits), redone)]

        return row

    source = state.select(id_col, "text", "n_tokens", "tree", edits_col)
    return map_rows(source, start, f"`{id_col}` {source.dtypes[0][1]}, text string, n_tokens bigint, tree binary, n_before bigint, n_edits bigint, n_redone bigint")


def cleaning_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Edits of a usual clean-up: single line ends become blank lines, runs of one punctuation mark shrink to one, long numbers become zeros."""
    for m in CLEANING.finditer(text):
        if m.lastgroup == "line":
            yield m.end(), m.end(), "\n"
        elif m.lastgroup == "mark":
            yield m.start() + 1, m.end(), ""
        else:
            yield m.start(), m.end(), "0"


CLEANING = regex.compile(r"(?P<line>(?<!\n)\n(?!\n))|(?P<mark>([^\w\s])\3{2,})|(?P<number>\d{5,})")
