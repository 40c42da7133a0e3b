"""The stages against brute force, each on its own input."""

import pytest

import corpus_pipeline
from basket_marts.llm.common import stored

FOLDER = "/root/testdata/sf0.01"
NUMBERS = [3, 1, 7, 6, 8]


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], FOLDER), name))
    return found


def test_all_but_the_last_return_documents(outputs):
    for before in outputs[:-1]:
        assert before.dtypes == outputs[0].dtypes


def test_rejected_documents_go(spark, outputs):
    ids = {r.doc_id for r in outputs[1].select("doc_id").collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [r.doc_id in ids for r in labels if r.quality == 1]
    bad = [r.doc_id in ids for r in labels if r.quality == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


def test_lines_go_and_documents_stay(outputs):
    before = {r.doc_id: r for r in outputs[1].collect()}
    after = {r.doc_id: r for r in outputs[2].collect()}
    assert set(before) == set(after)
    for doc_id, row in after.items():
        assert row.n_chars == len(row.text)
        lines = iter(before[doc_id].text.split("\n"))
        assert all(line in lines for line in row.text.split("\n")) or row.text == ""
    assert sum(r.n_chars for r in after.values()) < sum(r.n_chars for r in before.values())


def test_one_of_each_group_stays(outputs):
    from llm.test_ngram_join import brute_force

    rows = [(r.doc_id, r.text) for r in outputs[2].collect()]
    expected = {i for i, n, component in brute_force(rows) if n == 0 or i == component}
    assert {r.doc_id for r in outputs[3].collect()} == expected


def test_contaminated_documents_go(spark, outputs):
    from llm.test_decontaminate import shingles

    items = [
        shingles(r.text.lower().split())
        for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    ]
    kept = {r.doc_id for r in outputs[4].collect()}
    for row in outputs[3].collect():
        own = shingles(row.text.lower().split())
        whole = any((item & own).total() == item.total() for item in items)
        none = all((item & own).total() == 0 for item in items)
        if whole or none:
            assert (row.doc_id in kept) == none


def test_all_documents_are_packed(outputs):
    from llm.test_packing import check_pieces, library_ids

    docs = outputs[4].collect()
    check_pieces(outputs[5].collect(), [(d.doc_id, library_ids(d.text) + [1]) for d in docs])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "line_dedup", "ngram_join", "decontaminate", "packing",
    ]


def test_what_a_stage_stored_on_the_way_is_removed(spark, tmp_path):
    from basket_marts.llm import common
    from basket_marts.session import folder_exists

    other = common.stored(spark.range(3), "other")
    mark = common.scratch_mark()
    middle = common.stored(spark.range(5), "middle")
    last = common.stored(middle.where("id > 1"), "last")
    common.keep_last_stored(spark, mark)
    later = common.stored(last.where("id > 2"), "later")
    common.keep_last_stored(spark, mark)
    assert later.count() == 2 and other.count() == 3 and common.scratch_mark() == mark + 1
    files = (*middle.inputFiles(), *last.inputFiles())
    assert files and not any(folder_exists(spark, file) for file in files)
