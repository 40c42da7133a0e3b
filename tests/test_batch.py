import json
import subprocess
import sys
import time
from pathlib import Path

import pytest
from conftest import as_rows
from pyspark.sql import functions as F

from basket_marts import __main__ as cli
from basket_marts import schemas
from basket_marts.plans import batch, benchmark
from basket_marts.plans.quality import ContractViolation
from basket_marts.queries import QUERIES
from basket_marts.session import build_session, scoped_conf, scratch_path
from basket_marts.sinks import to_parquet
from basket_marts.sources import Lake, SharedTables


@pytest.fixture(scope="module")
def data(spark, folder, tmp_path_factory):
    """The shared tables as a raw CSV drop."""
    root = tmp_path_factory.mktemp("data")
    tables = SharedTables(spark, folder)
    files = {
        schemas.PRIOR_ITEMS_FILE: tables.prior_items(),
        schemas.TRAIN_ITEMS_FILE: tables.train_items(),
        schemas.ORDERS_FILE: tables.orders(),
        "products.csv": tables.products(),
        "aisles.csv": tables.aisles(),
        "departments.csv": tables.departments(),
    }
    for file, rows in files.items():
        rows.write.csv(f"{root}/raw/{file}", header=True)
    return str(root)


def test_batch_publishes_what_the_queries_compute(spark, folder, data, tmp_path):
    lake, published = f"{tmp_path}/lake", f"{tmp_path}/published"
    held = spark.sparkContext._jsc.sc().getPersistentRDDs
    before = held().size()
    counts = batch.run_batch(spark, f"{data}/raw", lake, to_parquet(published))
    for name in schemas.MART_CONTRACTS:
        mart = spark.read.parquet(f"{published}/{name}")
        assert as_rows(mart) == as_rows(QUERIES[name](spark, folder))
        assert counts[name] == mart.count()
    assert held().size() == before
    # A second run replaces everything with the same rows.
    assert batch.run_batch(spark, f"{data}/raw", lake, to_parquet(published)) == counts


def test_cleaning_reports_rows_and_takes_a_file_count(spark, data, tmp_path):
    written = batch.clean(spark, f"{data}/raw", f"{tmp_path}/lake", item_files=3)
    lake = Lake(spark, f"{tmp_path}/lake")
    assert written == {name: lake.table(name).count() for name in written}
    assert len(list(Path(lake.table_path("order_products")).glob("*.parquet"))) == 3
    assert len(list(Path(lake.table_path("products")).glob("*.parquet"))) == 1
    assert lake.table("orders").dtypes == spark.createDataFrame([], schemas.ORDERS_SCHEMA).dtypes


def test_a_failed_check_stops_before_publishing(spark, data, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    batch.clean(spark, f"{data}/raw", lake.root)
    batch.build_marts(spark, lake.root)
    bad = lake.table("order_products").withColumn("reordered", F.lit(7)).cache()
    assert bad.count()
    bad.write.mode("overwrite").parquet(lake.table_path("order_products"))
    bad.unpersist()
    with pytest.raises(ContractViolation) as caught:
        batch.check_quality(spark, lake.root)
    assert list(caught.value.failed) == ["order_products.reordered_in_{0,1}"]


def test_command_line_runs_jobs_and_reports_failure(spark, data, tmp_path, monkeypatch):
    root = str(tmp_path)
    Path(root, "raw").symlink_to(f"{data}/raw")
    for job in ("clean", "marts", "dq", "publish"):
        assert cli.main([job, "--data-dir", root]) == 0
    assert Path(root, "published/mart_user_cohort").is_dir()
    spark.read.parquet(f"{root}/lake/marts/mart_user_cohort").where("false").write.mode(
        "overwrite"
    ).parquet(f"{root}/lake/marts/mart_aisle_reorder")
    monkeypatch.setattr(
        batch, "check_quality", lambda *_: (_ for _ in ()).throw(ContractViolation({"x": 1}))
    )
    assert cli.main(["dq", "--data-dir", root]) == 1


def test_benchmark_writes_one_metrics_document(spark, data, tmp_path):
    batch.clean(spark, f"{data}/raw", f"{tmp_path}/lake")
    batch.run_benchmark(spark, f"{data}/raw", f"{tmp_path}/lake", f"{tmp_path}/metrics", repeats=1)
    (document,) = Path(tmp_path, "metrics/benchmark").glob("*.json")
    figures = json.loads(document.read_text())
    items = Lake(spark, f"{tmp_path}/lake").table("order_products")
    assert figures["rows_order_products"] == items.count()
    assert figures["testA_broadcast_join_sec"] > 0 and figures["testB_speedup_x"] > 0
    assert figures["skew_product_id_max_rows"] >= figures["skew_product_id_median_rows"] > 0


def test_join_variants_agree(spark, data, tmp_path):
    batch.clean(spark, f"{data}/raw", f"{tmp_path}/lake")
    lake = Lake(spark, f"{tmp_path}/lake")
    items, products = lake.table("order_products"), lake.table("products")
    with scoped_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        counts = [
            as_rows(variant(items, products))
            for variant in (
                benchmark.shuffle_join_count,
                benchmark.merged_join_count,
                benchmark.broadcast_join_count,
            )
        ]
    assert counts[0] == counts[1] == counts[2]


def test_settings_come_back_even_after_an_error(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    with pytest.raises(RuntimeError):
        with scoped_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            assert spark.conf.get(key) == "-1"
            raise RuntimeError
    assert spark.conf.get(key, None) == before


def test_session_takes_what_the_environment_and_caller_name(spark, monkeypatch):
    monkeypatch.setenv("SPARK_SHUFFLE_PARTITIONS", "5")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = build_session("again", **{"spark.sql.ansi.enabled": "true"})
    assert session.conf.get("spark.sql.shuffle.partitions") == "5"
    session.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_is_gone_when_the_session_has_ended(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from basket_marts.session import scratch_path\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "s.range(5).write.parquet(scratch_path(s, 'x'))\n"
        f"import os; assert os.listdir('{tmp_path}/basket_marts')\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    deadline = time.monotonic() + 60
    while list(Path(tmp_path, "basket_marts").iterdir()) and time.monotonic() < deadline:
        time.sleep(0.5)
    assert not list(Path(tmp_path, "basket_marts").iterdir())


def test_scratch_paths_are_new_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{shared}/") and second.startswith(f"{shared}/")
