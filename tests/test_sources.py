from conftest import as_rows
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basket_marts import schemas
from basket_marts.session import ROWS_PER_SPLIT
from basket_marts.sources import RawFiles, SharedTables, read_csv


def test_csv_cells_go_by_position_and_bad_ones_are_null(spark, tmp_path):
    file = tmp_path / "dirty_items.csv"
    file.write_text(
        "product_id,order_id,reordered,add_to_cart_order\n"  # names swapped: ignored
        "1,10,1,0\n"
        "x,11,2,1\n"  # not a number
        "3,12\n"  # short
        "4,13,1,1,99\n"  # long
        ",,,\n"
    )
    frame = read_csv(spark, str(file), schemas.ITEMS_SCHEMA)
    assert frame.columns == ["order_id", "product_id", "add_to_cart_order", "reordered"]
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(
        [
            (1, 10, 1, 0),
            (None, 11, 2, 1),
            (3, 12, None, None),
            (4, 13, 1, 1),
            (None, None, None, None),
        ],
        key=str,
    )


def test_csv_files_read_as_one_table(spark, tmp_path):
    header = "order_id,product_id,add_to_cart_order,reordered\n"
    (tmp_path / schemas.PRIOR_ITEMS_FILE).write_text(header + "1,1,1,0\n1,2,2,1\n")
    (tmp_path / schemas.TRAIN_ITEMS_FILE).write_text(header + "2,1,1,1\n")
    raw = RawFiles(spark, str(tmp_path))
    assert raw.all_items().count() == 3
    assert raw.prior_items().count() == 2
    assert raw.train_items().count() == 1


def test_item_splits_add_up(spark, folder):
    tables = SharedTables(spark, folder)
    together = tables.tagged_items()
    assert as_rows(together.where("eval_set = 'prior'").drop("eval_set")) == as_rows(
        tables.prior_items()
    )
    assert as_rows(together.where("eval_set = 'train'").drop("eval_set")) == as_rows(
        tables.train_items()
    )


def _direct_history(orders):
    customer = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.row_number().over(customer).alias("order_number"),
        F.datediff("o_orderdate", F.lag("o_orderdate").over(customer))
        .cast("double")
        .alias("days_since_prior_order"),
    )


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_order_history_does_not_depend_on_how_customers_are_cut(spark, tmp_path, conf, parts):
    """Undated orders, orders without a customer, and one key far from all others."""
    day = F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id % 5 as int))")
    orders = spark.range(1, 601).select(
        F.when(F.col("id") == 600, 10**12).otherwise(F.col("id")).alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 40).alias("o_custkey"),
        F.when(F.col("id") % 2 == 0, day).alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    conf("spark.sql.shuffle.partitions", parts)
    history = SharedTables(spark, str(tmp_path)).orders()
    expected = _direct_history(orders)
    assert as_rows(history.select(*expected.columns)) == as_rows(expected)


def test_a_line_of_neither_split_is_an_error(spark, folder, tmp_path):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").limit(20)
    for status in ("'X'", "CAST(NULL AS STRING)"):
        lines.selectExpr("* EXCEPT (l_linestatus)", f"{status} AS l_linestatus").write.mode(
            "overwrite"
        ).parquet(f"{tmp_path}/lineitem.parquet")
        tables = SharedTables(spark, str(tmp_path))
        for rows in (tables.tagged_items(), tables.prior_items(), tables.train_items()):
            with pytest.raises(Exception, match="neither split|unknown line status|USER_RAISED"):
                rows.select("order_id").collect()


def test_order_history_of_one_dominant_customer_on_few_dates(spark, tmp_path, conf):
    days = F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id % 3 as int))")
    orders = spark.range(1, 301).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id")).alias("o_custkey"),
        days.alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    conf(ROWS_PER_SPLIT, "20")
    history = SharedTables(spark, str(tmp_path)).orders()
    expected = _direct_history(orders)
    assert as_rows(history.select(*expected.columns)) == as_rows(expected)
    assert history.agg(F.max("order_number")).first()[0] == 200
