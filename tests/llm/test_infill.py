import random
import re

import pytest

from basket_marts.llm import infill
from basket_marts.llm.infill import PLAIN, PSM, SPM, Draws, fill_in_middle, restore, restored, rewrite


def brute_force(doc_id, text, draws=Draws()):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    a, b, whether, which = draws.of(doc_id)
    low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or whether % 100 >= draws.rewritten:
        return len(units), PLAIN, None, None, text or ""
    if which % 100 < draws.suffix_first:
        return len(units), SPM, len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), PSM, len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(3)
    pieces = ["a", "é", "漢", "😀", "\n", "\n", " ", "<", ">", "P>", "<S", "\r\n", " "]
    yield from ("".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(300))
    yield from ["", "\n", "\n\n\n", "no end", "ends\n", "with <P> in it\nand more", "<<S>", "<M", "x" * 300_000]
    yield "many\n" * 50_000


@pytest.mark.parametrize("draws", [Draws(), Draws(rewritten=40, suffix_first=0), Draws(seed=1, suffix_first=100)])
def test_outputs_and_round_trip(spark, draws):
    rows = [(i - 5, t) for i, t in enumerate(texts())] + [(1, "a\nb\nc")] * 2 + [(400, None), (None, "x\ny"), (None, None)]
    found = restored(fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string"), draws))
    columns = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")
    expected = [(i, *brute_force(i, t, draws), t or "") for i, t in rows]
    assert sorted(map(str, map(tuple, found.select("doc_id", *columns).collect()))) == sorted(map(str, expected))


@pytest.mark.parametrize("form", [PSM, SPM])
def test_every_cut_comes_back(form):
    data = "ab\ncé\n<漢P>\n".encode()
    for first in range(len(data) + 1):
        for second in range(first, len(data) + 1):
            output = bytes(rewrite(data, form, first, second))
            assert len(output) == len(data) + 9 and bytes(restore(output, form)) == data


def test_odd_rows(odd):
    found = fill_in_middle(odd)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    expected = [(r.doc_id, *brute_force(r.doc_id, r.text)) for r in odd.collect()]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_restoring_keeps_other_columns_and_nulls(spark):
    rows = [(1, "psm", "<P>a<S>c<M>b", "x"), (2, None, "z", "x"), (3, "plain", None, None)]
    frame = spark.createDataFrame(rows, "rest bigint, form string, output string, restored string")
    found = restored(frame)
    assert found.columns == ["rest", "form", "output", "restored"]
    assert [r.restored for r in found.orderBy("rest").collect()] == ["abc", None, None]


def test_no_rows(no_rows):
    assert restored(fill_in_middle(no_rows)).collect() == []


def test_small_slices_change_nothing(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = sorted(map(tuple, fill_in_middle(docs).collect()), key=str)
    monkeypatch.setattr(infill, "SLICE_BYTES", 700)
    assert sorted(map(tuple, fill_in_middle(docs).collect()), key=str) == whole
