import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basket_marts.llm.common import library_tokenizer, vocabulary_path
from basket_marts.llm.queries import QUERIES
from basket_marts.llm.token_counts import TokenCounter, token_counts

PATH = vocabulary_path("byte_bpe_50k.json")
COUNTER = TokenCounter(PATH)


def by_library(texts):
    encoded = library_tokenizer(PATH).encode_batch(texts, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def test_special_strings_runs_and_scripts():
    texts = [
        "",
        " ",
        "a<|endoftext|>b <|endoftext|><|endoftext|>",
        "aaaaaaa" * 300,
        "ab" * 4000,
        "don't I'll  WE'VE\n\n\tx",
        "日本語 Ελληνικά ñandú 👩‍👩‍👧",
        "\x00\x1c\x85 \xa0",
    ]
    assert COUNTER(texts) == by_library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"])), max_size=5))
def test_any_text(texts):
    assert COUNTER(texts) == by_library(texts)


def test_counts_do_not_depend_on_what_is_remembered():
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcde ", k=200)) for _ in range(50)]
    assert TokenCounter(PATH)(texts) == [TokenCounter(PATH)([t])[0] for t in texts]


def test_odd_rows(odd):
    rows = token_counts(odd, PATH).collect()
    expected = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    lengths = by_library([t for _, t in expected])
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (i, len(t.encode()), n, n > 512) for (i, t), n in zip(expected, lengths)
    ]


def test_no_rows(no_rows):
    assert token_counts(no_rows, PATH).collect() == []


def test_query(spark, small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op10_token_counts"](spark, small).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == dict(zip(texts, by_library(list(texts.values()))))


@pytest.mark.parametrize("limit", [0, 5])
def test_limit(spark, limit):
    rows = spark.createDataFrame([(1, "one two three four five six")], "doc_id bigint, text string")
    assert token_counts(rows, PATH, limit).first().over_limit is True
