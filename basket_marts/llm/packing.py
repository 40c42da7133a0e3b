"""Packing documents into token windows by multiway Karmarkar-Karp differencing.

A document's ids fill whole windows first. The remainders of consecutive documents gather
in a group that holds a whole number of windows (the last remainder is cut to fit, its rest
opens the next group) and are differenced into that many windows: the two partial
partitions that are least balanced are merged, the fullest part of one with the emptiest of
the other, until one partition is left. What a window then holds beyond its capacity is cut
off and goes where there is room. The window count is that of the group's ids and rises by
one whenever they exceed the capacity, so that a task pads its last group only.

Nothing is shuffled: a task packs the rows it reads, and a re-run packs them alike.
"""

from __future__ import annotations

import heapq
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from basket_marts.llm.common import library_tokenizer, remembered, text_slices
from basket_marts.llm.token_counts import byte_symbols

CAPACITY = 2048
END_ID = 1
# Windows that are differenced together: a bound on a task's memory and on the vectors' length.
GROUP_WINDOWS = 128
# Ids of so many words and pieces of words up to this long are remembered: some 230 MB a task.
REMEMBERED_LENGTH, REMEMBERED_WORDS, REMEMBERED_PIECES = 64, 600_000, 600_000
SLICE_BYTES = 1 << 20

# Fixed value: the pattern of this vocabulary file for pieces of lower-case text.
WORD_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Marks that this pattern takes together, behind letters too: not the quote, nor what the
# vocabulary's special strings begin and end with.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"

_ID = np.dtype("<u4")


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Spread items over `k` parts of near-equal sums; the parts as lists of item positions."""
    # A partial partition: sums and tree nodes of its k parts, fullest first. Node -1 is an
    # empty part, a node below len(sizes) an item, any other one a pair of nodes.
    pairs: list[tuple[int, int]] = []
    heap = []
    for item, size in enumerate(sizes):
        sums, nodes = np.zeros(k, dtype=np.int64), np.full(k, -1, dtype=np.int64)
        sums[0], nodes[0] = size, item
        heap.append((-size, item, sums, nodes))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other_sums, other_nodes = heapq.heappop(heap)
        sums, other_nodes = sums + other_sums[::-1], other_nodes[::-1]
        both = np.flatnonzero((nodes >= 0) & (other_nodes >= 0))
        fresh = np.arange(len(pairs), len(pairs) + len(both)) + len(sizes)
        pairs += zip(nodes[both].tolist(), other_nodes[both].tolist())
        nodes = np.maximum(nodes, other_nodes)
        nodes[both] = fresh
        by_sum = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by_sum], nodes[by_sum]
        # Only imbalance counts: the emptiest part becomes the zero of this partition.
        sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), order, sums, nodes))
        order += 1

    def items(node: int) -> list[int]:
        found, waiting = [], [node] if node >= 0 else []
        while waiting:
            node = waiting.pop()
            if node < len(sizes):
                found.append(node)
            else:
                waiting += pairs[node - len(sizes)]
        return sorted(found)

    return [items(node) for node in heap[0][3].tolist()] if heap else [[] for _ in range(k)]


class Piece:
    """Ids of one document, `start` ids into it."""

    __slots__ = ("doc_id", "ids", "start", "doc_tokens")

    def __init__(self, doc_id, ids: bytes, start: int, doc_tokens: int):
        self.doc_id, self.ids, self.start, self.doc_tokens = doc_id, ids, start, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // _ID.itemsize

    def cut(self, length: int) -> tuple[Piece, Piece]:
        at = length * _ID.itemsize
        return (
            Piece(self.doc_id, self.ids[:at], self.start, self.doc_tokens),
            Piece(self.doc_id, self.ids[at:], self.start + length, self.doc_tokens),
        )


def pack_group(pieces: list[Piece], capacity: int = CAPACITY) -> list[list[Piece]]:
    """Windows of at most `capacity` ids over pieces, none of which is longer."""
    count = -(-sum(map(len, pieces)) // capacity)
    windows, over, open_windows = [], [], []
    for part in difference([len(p) for p in pieces], count) if count else []:
        window, held = [], 0
        for piece in (pieces[i] for i in part):
            if held + len(piece) > capacity:
                kept, rest = piece.cut(capacity - held)
                over.append(rest)
                piece = kept
            if len(piece):
                window.append(piece)
                held += len(piece)
        windows.append(window)
        if held < capacity:
            open_windows.append((window, capacity - held))
    for piece in over:
        while len(piece):
            window, room = open_windows.pop()
            taken, piece = piece.cut(min(room, len(piece)))
            window.append(taken)
            if room > len(taken):
                open_windows.append((window, room - len(taken)))
    return windows


class Packer:
    """Takes documents one after another and gives back windows as they are complete."""

    def __init__(self, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS):
        self.capacity, self.group = capacity, capacity * group_windows
        self.waiting: list[Piece] = []
        self.held = 0

    def add(self, doc_id, ids: bytes) -> Iterator[list[Piece]]:
        piece = Piece(doc_id, ids, 0, len(ids) // _ID.itemsize)
        while len(piece) >= self.capacity:
            whole, piece = piece.cut(self.capacity)
            yield [whole]
        if self.held + len(piece) >= self.group:
            last, piece = piece.cut(self.group - self.held)
            self.waiting.append(last)
            yield from self.end()
        if len(piece):
            self.waiting.append(piece)
            self.held += len(piece)

    def end(self) -> Iterator[list[Piece]]:
        waiting, self.waiting, self.held = self.waiting, [], 0
        yield from pack_group([p for p in waiting if len(p)], self.capacity)


class WordIds(dict):
    """Ids by word: those of a word that is not there are found when it is asked for.

    A word not met before is normalised and cut as the vocabulary file says, and its pieces
    go through the library's model; one that holds a special string or other than Latin
    letters goes through the library as it is. Long words are remembered for one text.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = library_tokenizer(path)
        self.model = self.tokenizer.model
        self.of_byte = dict(enumerate(byte_symbols()))
        self.piece = regex.compile(WORD_PIECE)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Outside Latin letters, libraries may know different versions of Unicode.
        self.by_library = regex.compile("|".join([r"[^\0-\u024f]", *map(regex.escape, specials)]))
        self.pieces: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(word) <= REMEMBERED_LENGTH:
            self[word] = ids = self._word_ids(word)
            return ids
        ids = self.long.get(word)
        if ids is None:
            self.long[word] = ids = self._word_ids(word)
        return ids

    def _piece_ids(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            symbols = piece
            if not (piece.isascii() and piece.isprintable()):
                symbols = piece.encode("utf-8").decode("latin-1").translate(self.of_byte)
            found = [t.id for t in self.model.tokenize(symbols)]
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(piece) <= REMEMBERED_LENGTH:
                self.pieces[piece] = ids
        return ids

    def _word_ids(self, word: str) -> bytes:
        # Most words are letters, then marks: one piece each, and no special string is so.
        if word.isascii() or max(word) <= "\u024f":
            lowered = unicodedata.normalize("NFC", word).lower()
            stem = lowered.rstrip(MARKS)
            if stem.isalpha():
                marks = lowered[len(stem) :]
                return self._piece_ids(stem) + (self._piece_ids(marks) if marks else b"")
        if self.by_library.search(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return np.array(ids, dtype=_ID).tobytes()
        lowered = unicodedata.normalize("NFC", word).lower()
        return b"".join(map(self._piece_ids, self.piece.findall(lowered)))


class TextIds:
    """Ids of whole texts, put together from remembered ids of their words.

    The vocabulary drops white space and its patterns never match across it, so a text's
    ids are those of its words between spaces and line feeds.
    """

    def __init__(self, path: str):
        self.words = WordIds(path)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        words = self.words
        if len(words) > REMEMBERED_WORDS:
            words.clear()
        if len(words.pieces) > REMEMBERED_PIECES:
            words.pieces.clear()
        words[""] = b""
        for text in texts:
            yield b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))
            words.long.clear()


@remembered
def _text_ids(path: str) -> TextIds:
    return TextIds(path)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.list_(pa.int64())),
    ]
)


def packed_sequences(
    texts: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pack rows of (doc_id, text) into sequences of at most `capacity` ids.

    Each document is the ids of its text and then `END_ID`. Each id lies in exactly one
    piece; a row per piece says where it begins in the document (`start`) and in its
    sequence (`offset`, gapless from 0). `sequence_id` is the task's number, shifted, plus a
    count. `ids` is filled on request. A sequence is to be padded up to `capacity` unless
    its length is a power of two.

    A NULL or empty text is a document of one id; a NULL doc_id is kept; repeated rows are
    packed each; other columns are not read; an empty table gives no rows.
    """
    end = np.array([END_ID], dtype=_ID).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_ids, packer = _text_ids(path), Packer(capacity)
        sequence = TaskContext.get().partitionId() << 36

        def rows(windows: Iterator[list[Piece]]) -> list[dict]:
            nonlocal sequence
            found = []
            for window in windows:
                offset = 0
                for piece in window:
                    row = {
                        "doc_id": piece.doc_id,
                        "start": piece.start,
                        "length": len(piece),
                        "ids_crc32": zlib.crc32(piece.ids),
                        "doc_tokens": piece.doc_tokens,
                        "sequence_id": sequence,
                        "offset": offset,
                        "ids": np.frombuffer(piece.ids, _ID).tolist() if with_ids else None,
                    }
                    found.append(row)
                    offset += len(piece)
                sequence += 1
            return found

        for batch in text_slices(batches, size=SLICE_BYTES):
            doc_ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").fill_null("").to_pylist()
            found = []
            for doc_id, ids in zip(doc_ids, text_ids(texts)):
                found += rows(packer.add(doc_id, ids + end))
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)
        if found := rows(packer.end()):
            yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)

    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, ids array<bigint>"
    )
    packed = texts.select("doc_id", "text").mapInArrow(pack, schema)
    return packed if with_ids else packed.drop("ids")
