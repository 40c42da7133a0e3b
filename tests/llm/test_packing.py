import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basket_marts.llm.common import library_tokenizer, vocabulary_path
from basket_marts.llm.packing import (
    CAPACITY,
    Packer,
    Piece,
    TextIds,
    difference,
    pack_group,
    packed_sequences,
)
from basket_marts.llm.queries import QUERIES

PATH = vocabulary_path("word_bpe_49k.json")


def library_ids(text):
    return library_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_differencing_keeps_items_and_balances():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 1000) for _ in range(400)]
    parts = difference(sizes, 25)
    assert sorted(i for part in parts for i in part) == list(range(400))
    sums = [sum(sizes[i] for i in part) for part in parts]
    assert max(sums) - min(sums) <= 10


def test_differencing_small_cases():
    assert difference([], 2) == [[], []]
    assert difference([5], 1) == [[0]]
    assert sorted(map(sorted, difference([8, 7, 6, 5, 4], 2))) in ([[0, 1], [2, 3, 4]], [[0, 3], [1, 2, 4]], [[0, 4], [1, 2, 3]], [[0, 2], [1, 3, 4]])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_groups_fill_as_few_windows_as_possible(lengths):
    pieces = [Piece(i, np.arange(n, dtype="<u4").tobytes(), 0, n) for i, n in enumerate(lengths)]
    windows = pack_group(pieces, 50)
    assert len(windows) == -(-sum(lengths) // 50)
    assert all(0 < sum(map(len, w)) <= 50 for w in windows)
    found = defaultdict(list)
    for window in windows:
        for piece in window:
            found[piece.doc_id].append(piece)
    for i, n in enumerate(lengths):
        parts = sorted(found[i], key=lambda p: p.start)
        assert b"".join(p.ids for p in parts) == np.arange(n, dtype="<u4").tobytes()


def test_packer_pads_its_last_group_only():
    packer, rng = Packer(64, 4), random.Random(1)
    windows = []
    for i in range(100):
        windows += packer.add(i, np.zeros(rng.randrange(1, 200), dtype="<u4").tobytes())
    before = len(windows)
    windows += packer.end()
    assert all(sum(map(len, w)) == 64 for w in windows[:before])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"])))
def test_ids_are_the_librarys(text):
    assert b"".join(TextIds(PATH)([text])) == np.array(library_ids(text), dtype="<u4").tobytes()


@pytest.mark.parametrize(
    "text", ["A<|endoftext|>b", "x <|startoftext|> y", "ΣΑΣ İ é́", "'s '' don't", "\x1c \x00a", "z" * 500]
)
def test_ids_of_odd_texts(text):
    assert b"".join(TextIds(PATH)([text])) == np.array(library_ids(text), dtype="<u4").tobytes()


def test_words_of_letters_and_marks_are_not_searched():
    text_ids = TextIds(PATH)
    plain = "The END.!! àÉß, ªx$$$ ǅ(_) zz;\nthe"
    # Neither a search for special strings nor the vocabulary's pattern is needed for these.
    text_ids.words.by_library = text_ids.words.piece = None
    assert b"".join(text_ids([plain])) == np.array(library_ids(plain), dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZéßİȺª'sltm.,!|<>$_ \n\t1²½·\u0301\x1c", max_size=40))
def test_ids_of_words_with_marks(text):
    assert b"".join(TextIds(PATH)([text])) == np.array(library_ids(text), dtype="<u4").tobytes()


def test_long_words_are_remembered_for_one_text():
    text_ids, text = TextIds(PATH), f"{'ab' * 90} x {'ab' * 90} {'é,' * 70}"
    expected = np.array(library_ids(text), dtype="<u4").tobytes()
    assert list(text_ids([text, "", text])) == [expected, b"", expected]
    assert not text_ids.words.long and max(map(len, text_ids.words)) <= 64


def check_pieces(rows, ids_of_rows):
    """Every id in one piece, windows gapless and within capacity."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= CAPACITY
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append((row.start, row.length, row.ids_crc32, row.doc_tokens))
    expected = defaultdict(list)
    for doc_id, ids in ids_of_rows:
        expected[doc_id].append(ids)
    assert set(pieces) == set(expected)
    for doc_id, all_ids in expected.items():
        if len(all_ids) > 1:
            continue
        (ids,), at = all_ids, 0
        for start, length, crc, total in sorted(pieces[doc_id]):
            data = np.array(ids[start : start + length], dtype="<u4").tobytes()
            assert (start, crc, total) == (at, zlib.crc32(data), len(ids))
            at += length
        assert at == len(ids)
    return sum(CAPACITY - sum(n for _, n in p) for p in sequences.values())


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = QUERIES["op8_packing"](spark, small).collect()
    padding = check_pieces(rows, [(d.doc_id, library_ids(d.text) + [1]) for d in docs])
    assert padding < CAPACITY * 4  # at most one short window a task


def test_odd_rows(odd):
    rows = packed_sequences(odd, PATH, with_ids=True).collect()
    check_pieces(rows, [(r["doc_id"], library_ids(r["text"]) + [1]) for r in odd.collect()])
    assert [r.ids for r in rows if r.doc_id == 2] == [[1]]


def test_no_rows(no_rows):
    assert packed_sequences(no_rows, PATH).collect() == []
