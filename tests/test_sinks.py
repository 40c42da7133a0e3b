import json
from pathlib import Path

import pytest
from conftest import as_rows

from basket_marts.schemas import MART_CONTRACTS
from basket_marts.sinks import (
    publish_mart,
    run_to_nowhere,
    to_catalog,
    to_jdbc,
    to_parquet,
    write_compact,
    write_even,
    write_json,
    write_natural,
)
from basket_marts.session import remove_folder, replace_folder
from basket_marts.sinks.publish import PublishError

NAME = "mart_product_rank"
CONTRACT = MART_CONTRACTS[NAME]


def _files(path):
    return [f for f in Path(path).iterdir() if f.suffix == ".parquet"]


def test_compact_writes_one_file_for_a_small_result(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_compact(spark.range(100).repartition(7), path) == 100
    assert len(_files(path)) == 1
    assert write_compact(spark.range(5), path) == 5  # overwrites
    assert spark.read.parquet(path).count() == 5


def test_even_writes_the_number_of_files_asked_for(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_even(spark.range(90), path, files=3) == 90
    assert len(_files(path)) == 3
    assert {spark.read.parquet(str(f)).count() for f in _files(path)} == {30}


def test_natural_keeps_the_partitions(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_natural(spark.range(10).repartition(2), path) == 10
    assert len(_files(path)) == 2


def test_nowhere_runs_the_plan(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    run_to_nowhere(spark.range(20).mapInPandas(touch, "id BIGINT"))
    assert seen.value == 20


def test_json_is_one_document(spark, tmp_path):
    write_json(spark.sql("SELECT 1 AS a, 2.5D AS b"), f"{tmp_path}/out")
    (document,) = Path(tmp_path, "out").glob("*.json")
    assert json.loads(document.read_text()) == {"a": 1, "b": 2.5}


@pytest.fixture
def mart(spark):
    rows = [(3, 1, "x", "b"), (2, 2, "y", "b"), (9, 1, "z", "a")]
    return spark.createDataFrame(
        rows, "n_items INT, rnk BIGINT, product_name STRING, department STRING"
    ).repartition(3)


def test_published_mart_is_typed_sorted_and_repeatable(spark, mart, tmp_path):
    for _ in range(2):
        assert publish_mart(mart, NAME, CONTRACT, to_parquet(str(tmp_path))) == 3
    published = spark.read.parquet(f"{tmp_path}/{NAME}")
    assert dict(published.dtypes) == CONTRACT.columns
    assert published.columns == list(CONTRACT.columns)
    (file,) = _files(tmp_path / NAME)
    stored = spark.read.parquet(str(file)).collect()
    assert [(r.department, r.rnk) for r in stored] == [("a", 1), ("b", 1), ("b", 2)]


@pytest.mark.parametrize(
    "row", [(None, 1, "x", "b"), (1, None, "x", "b"), (1, 1, "x", None), (-1, 1, "x", "b")]
)
def test_a_broken_mart_leaves_the_published_one_alone(spark, mart, tmp_path, row):
    writer = to_parquet(str(tmp_path))
    publish_mart(mart, NAME, CONTRACT, writer)
    before = as_rows(spark.read.parquet(f"{tmp_path}/{NAME}"))
    with pytest.raises(PublishError):
        publish_mart(mart.union(spark.createDataFrame([row], mart.schema)), NAME, CONTRACT, writer)
    assert as_rows(spark.read.parquet(f"{tmp_path}/{NAME}")) == before


def test_publishing_to_the_catalog_replaces_the_table(spark, mart):
    writer = to_catalog("basket_test")
    publish_mart(mart, NAME, CONTRACT, writer)
    publish_mart(mart.where("department = 'a'"), NAME, CONTRACT, writer)
    assert spark.table(f"basket_test.{NAME}").count() == 1
    spark.sql("DROP DATABASE basket_test CASCADE")


def test_jdbc_truncates_instead_of_dropping():
    calls = {}

    class Writer:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **options):
            calls.update(options)
            return self

        def mode(self, name):
            calls["mode"] = name
            return self

        def save(self):
            calls["saved"] = True

    class Rows:
        write = Writer()

    to_jdbc("jdbc:x", user="u")(Rows(), NAME)
    assert calls == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": NAME,
        "truncate": "true",
        "user": "u",
        "mode": "overwrite",
        "saved": True,
    }


def test_a_failed_move_leaves_the_old_mart_and_nothing_staged(spark, mart, tmp_path, monkeypatch):
    writer = to_parquet(str(tmp_path))
    publish_mart(mart, NAME, CONTRACT, writer)
    before = as_rows(spark.read.parquet(f"{tmp_path}/{NAME}"))

    def fail(spark, staged, target):
        remove_folder(spark, staged)  # the move will not find what it should move
        replace_folder(spark, staged, target)

    monkeypatch.setattr("basket_marts.sinks.publish.replace_folder", fail)
    with pytest.raises(Exception, match="cannot move|does not exist|FileNotFound"):
        publish_mart(mart.limit(1), NAME, CONTRACT, writer)
    assert as_rows(spark.read.parquet(f"{tmp_path}/{NAME}")) == before
    assert [p.name for p in tmp_path.iterdir()] == [NAME]
