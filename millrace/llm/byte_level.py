"""Byte-level BPE vocabularies of tokenizer JSON files, for the operators that encode with them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 characters for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Token bytes by id, the special strings with their ids, and the pattern that splits texts before the merges."""

    ranks: dict[bytes, int]
    specials: dict[str, int]
    pattern: str
    _made: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"ranks": self.ranks, "specials": self.specials, "pattern": self.pattern, "_made": {}}

    @cached_property
    def size(self) -> int:
        return 1 + max([*self.ranks.values(), *self.specials.values()])

    @cached_property
    def bytes_of(self) -> list[bytes]:
        out = [b""] * self.size
        for token, i in self.ranks.items():
            out[i] = token
        for content, i in self.specials.items():
            out[i] = content.encode()
        return out

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.bytes_of], np.int64)

    def encoder(self):
        """Text to ids by the merges alone; special strings are plain text."""
        if "encoder" not in self._made:
            self._made["encoder"] = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return self._made["encoder"].encode_ordinary


def as_ranges(chars: list[str]) -> str:
    """A character class's inside."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


def classes_of(path: str) -> dict[str, str]:
    """The letters and numbers of the Unicode version that the file's own library splits by: characters that it keeps together with an "a" or a "1"."""
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def together(first: str, name: str) -> str:
        known = regex.compile(name)
        some = [c for c in map(chr, range(0x110000)) if known.match(c)]
        spans = {span for _, span in split("".join(f"{first}{c}\n" for c in some))}
        return as_ranges([c for i, c in enumerate(some) if (3 * i, 3 * i + 2) in spans])

    return {r"\p{L}": together("a", r"\p{L}"), r"\p{N}": together("1", r"\p{N}")}


@lru_cache(4)
def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """A tokenizer JSON file with a byte-level vocabulary. Its merges have to come in id order, so that ids say which merge goes first.

    Libraries know different versions of Unicode; the pattern's letters and numbers become those of the file's own.
    """
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, symbols = said["model"], byte_symbols()
    specials = {t["content"]: t["id"] for t in said.get("added_tokens", [])}
    ranks = {bytes(symbols[c] for c in token): i for token, i in model["vocab"].items() if token not in specials}
    merges = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    order = [model["vocab"][m.replace(" ", "")] for m in merges]
    if order != sorted(order) or said.get("normalizer"):
        raise ValueError(f"{path}: not a byte-level vocabulary whose merges follow its ids")
    for name, inside in classes_of(path).items():
        pattern = regex.sub(r"(\[[^]]*)" + regex.escape(name), lambda m: m[1] + inside, pattern).replace(name, f"[{inside}]")
    return Vocabulary(ranks, specials, pattern)
