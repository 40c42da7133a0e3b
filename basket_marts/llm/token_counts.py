"""Token counts of a byte-level BPE by rank-synchronous array merging.

A text is cut at the vocabulary's special strings (one token each) and then into
pre-tokens. Pre-tokens not met before are held together as one ragged numpy array of
symbols; each step finds every sequence's lowest-rank adjacent pair and applies it to all
of its occurrences, in all sequences at once, until no pair is left. The surviving symbols
are counted. Counts of pre-tokens are remembered in the task, within a bound.

A merge only creates pairs of higher rank than its own, so applying the lowest pair
everywhere at once gives what merging one occurrence at a time gives; in a run such as
`aaa` occurrences are taken from the left.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from basket_marts.llm.common import text_slices

TOKEN_LIMIT = 512
# Bounds of one task's memory: pre-tokens remembered, bytes of text pre-tokenized at once.
REMEMBERED = 400_000
SLICE_BYTES = 1 << 20

# Fixed value: the pre-token pattern that byte-level vocabularies of this kind are made for.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NO_PAIR = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


class PairRanks:
    """Merge ranks of adjacent symbol pairs, looked up for whole arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        result = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order, result[order]
        self.of_byte = np.array([vocabulary[c] for c in byte_symbols()], dtype=np.int64)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """How many symbols of each byte sequence survive the merging."""
        survivors = np.zeros(len(sequences), dtype=np.int64)
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[place] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[place], _NO_PAIR), _NO_PAIR)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(starts, append=len(owner))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)

            ended = lowest == _NO_PAIR
            at = np.flatnonzero((rank == lowest) & ~ended)
            # Of overlapping occurrences every other one is taken, from the left.
            new_run = np.diff(at, prepend=-2) != 1
            in_run = np.arange(len(at)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            at = at[in_run % 2 == 0]
            symbols[at] = self.results[place[at]]

            survivors[owner[starts]] += np.where(ended[starts], sizes, 0)
            keep = ~ended
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return survivors


class TokenCounter:
    def __init__(self, path: str):
        self.pairs = PairRanks(path)
        self.pattern = regex.compile(PRE_TOKEN)
        specials = sorted(self.pairs.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        """Token counts of texts that together are small."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        base, pre_tokens = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            base.append(len(parts) - 1)
            pre_tokens.append([t for part in parts for t in self.pattern.findall(part)])
        new = list(set().union(*pre_tokens) - self.known.keys())
        if new:
            counts = self.pairs.counts([t.encode("utf-8") for t in new])
            self.known.update(zip(new, counts.tolist()))
        known = self.known.__getitem__
        return [n + sum(map(known, tokens)) for n, tokens in zip(base, pre_tokens)]


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(texts: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per row of (doc_id, text): n_bytes, n_tokens, and whether they exceed `limit`.

    `path` names a byte-level BPE in the `tokenizers` JSON format, readable on every
    executor. Rows keep their order and number; other columns are not read. A NULL text
    counts as empty (0 bytes, 0 tokens), a NULL doc_id is kept. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in text_slices(batches, size=SLICE_BYTES):
            texts = batch.column("text").fill_null("")
            n_tokens = np.array(counter(texts.to_pylist()), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.compute.binary_length(texts).cast(pa.int64()),
                    pa.array(n_tokens),
                    pa.array(n_tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return texts.select("doc_id", "text").mapInArrow(count, schema)
