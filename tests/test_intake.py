"""Every raw row is kept, a copy, or rejected with its reason; nothing vanishes unreported."""

from pathlib import Path

import pytest
from conftest import as_rows, plan_of
from pyspark.sql import functions as F

from basket_marts import __main__ as cli
from basket_marts import schemas
from basket_marts.plans import batch, intake
from basket_marts.plans.cleaning import clean_items
from basket_marts.sinks import write_natural
from basket_marts.sources import Lake, RawFiles, read_csv, read_csv_audited
from basket_marts.sources.raw_files import split_of_file

ITEM_LINES = """order_id,product_id,add_to_cart_order,reordered
1,10,1,0
1,10,1,0
x,11,2,1
2,,1,0
,,,
3,12
4,13,zz,1
5,14,1,1,surplus
6,"7,8",1,0
,15,zz,1
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    write(root / schemas.PRIOR_ITEMS_FILE, ITEM_LINES)
    write(root / schemas.TRAIN_ITEMS_FILE, "order_id,product_id,add_to_cart_order,reordered\n7,10,1,0\n1,10,0,1\n")
    write(root / "products.csv", "product_id,product_name,aisle_id,department_id\n10,pear,1,1\n10,apple,1,1\n")
    write(root / "aisles.csv", "aisle_id,aisle\n1,fruit\n")
    write(root / "departments.csv", "department_id,department\none,food\n")
    write(
        root / schemas.ORDERS_FILE,
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "1,5,prior,1,0,9,\n2,,prior,1,0,9,3.5\n3,6,prior,1,0,nine,\n",
    )
    return root


def accounts_of(found):
    return {a.table_name: (a.rows_read, a.kept, a.duplicates, a.rejected, a.damaged) for a in found}


def test_accounts_and_rejects(spark, raw, tmp_path):
    found = batch.clean_audited(spark, str(raw), f"{tmp_path}/lake")
    lake = Lake(spark, f"{tmp_path}/lake")
    assert accounts_of(found) == {
        "products": (2, 1, 1, 0, 0),
        "aisles": (1, 1, 0, 0, 0),
        "departments": (1, 0, 0, 1, 0),
        "orders": (3, 2, 0, 1, 1),
        # 3, 4 and 5 are in the table without the cells that could not be read.
        "order_products": (12, 5, 2, 5, 3),
    }
    assert accounts_of(lake.accounts().collect()) == accounts_of(found)
    assert all(a.rows_read == a.kept + a.duplicates + a.rejected for a in found)
    assert all(lake.table(a.table_name).count() == a.kept for a in found)
    rejects = {(r.reason, r.record) for r in lake.rejects("order_products").collect()}
    assert rejects == {
        (intake.MALFORMED, "x,11,2,1"),
        (intake.MISSING_KEY, "2,,1,0"),
        (intake.MISSING_KEY, ",,,"),
        (intake.MALFORMED, '6,"7,8",1,0'),
        (intake.MALFORMED, ",15,zz,1"),
    }
    assert {Path(r.file).name for r in lake.rejects("order_products").collect()} == {schemas.PRIOR_ITEMS_FILE}
    assert [r.record for r in lake.rejects("orders").collect()] == ["2,,prior,1,0,9,3.5"]
    assert lake.rejects("aisles").count() == 0


def test_the_table_is_the_one_that_unaudited_cleaning_writes(spark, raw, tmp_path):
    batch.clean_audited(spark, str(raw), f"{tmp_path}/a", item_files=2)
    written = batch.clean(spark, str(raw), f"{tmp_path}/b")
    for name in written:
        one, other = Lake(spark, f"{tmp_path}/a").table(name), Lake(spark, f"{tmp_path}/b").table(name)
        assert as_rows(one) == as_rows(other) and one.dtypes == other.dtypes


def test_a_second_run_replaces_what_was_rejected(spark, raw, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    batch.clean_audited(spark, str(raw), lake.root)
    write(raw / schemas.PRIOR_ITEMS_FILE, "order_id,product_id,add_to_cart_order,reordered\n1,10,1,0\n")
    assert accounts_of(batch.clean_audited(spark, str(raw), lake.root))["order_products"] == (3, 2, 1, 0, 0)
    assert lake.rejects("order_products").count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_counts_are_there_when_every_row_is_rejected(spark, tmp_path, conf, adaptive):
    conf("spark.sql.adaptive.enabled", adaptive)
    header = "order_id,product_id,add_to_cart_order,reordered\n"
    write(tmp_path / schemas.PRIOR_ITEMS_FILE, header + "x,1,1,1\n,2,1,1\n")
    write(tmp_path / schemas.TRAIN_ITEMS_FILE, header)
    items = RawFiles(spark, str(tmp_path), audited=True).tagged_items()
    account = intake.take_in(
        items, "items", schemas.ITEM_KEYS, clean_items,
        lambda rows: write_natural(rows, f"{tmp_path}/out"), f"{tmp_path}/rejects",
    )
    assert account == intake.Account("items", 2, 0, 0, 2, 0)
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 2


def test_only_files_with_rejects_are_read_again(spark, raw):
    items = RawFiles(spark, str(raw), audited=True).tagged_items()
    file = items.where("eval_set = 'train'").select("_file").first()[0]
    again = intake.rejected_rows(items.where(F.col("_file").isin([file])), "items", schemas.ITEM_KEYS)
    assert again.count() == 0
    plan = plan_of(again)
    assert plan.count("FileScan") == 1 and "file_path" in plan


def test_odd_records_are_marked_and_rows_stay_the_same(spark, raw):
    path = f"{raw}/{schemas.PRIOR_ITEMS_FILE}"
    rows = read_csv_audited(spark, path, schemas.ITEMS_SCHEMA)
    assert sum(r._record is not None for r in rows.collect()) == 6
    # Missing and surplus cells are noticed whatever columns are used.
    some = rows.select("order_id", "_record").where("_record IS NOT NULL")
    assert {"3,12", "5,14,1,1,surplus"} <= {r._record for r in some.collect()}
    plain = read_csv(spark, path, schemas.ITEMS_SCHEMA)
    assert as_rows(rows.select(*plain.columns)) == as_rows(plain)


def test_both_splits_are_one_scan(spark, raw):
    for audited in (False, True):
        items = RawFiles(spark, str(raw), audited=audited).tagged_items()
        counts = items.groupBy("eval_set").count()
        assert {tuple(r) for r in counts.collect()} == {("prior", 10), ("train", 2)}
        assert plan_of(counts).count("FileScan") == 1


def test_a_file_of_neither_split_is_an_error(spark, tmp_path):
    write(tmp_path / "order_products__test.csv", "order_id,product_id,add_to_cart_order,reordered\n1,1,1,1\n")
    rows = read_csv_audited(spark, str(tmp_path / "order_products__test.csv"), schemas.ITEMS_SCHEMA)
    with pytest.raises(Exception, match="neither split"):
        rows.select(split_of_file(F.col("_file"))).collect()


def test_command_line_prints_accounts(spark, raw, tmp_path, capsys):
    assert cli.main(["clean", "--data-dir", str(tmp_path)]) == 0
    assert "table_name='order_products', rows_read=12" in capsys.readouterr().out
