"""The retail-basket tables expressed over the shared test tables (FIXTURES.md section 2)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basket_marts.schemas import ITEMS_SCHEMA, ORDERS_SCHEMA, PRIOR, TRAIN
from basket_marts.session import scratch_path


class SharedTables:
    """Raw basket tables, before cleaning, over `lineitem`, `orders` and `part`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        # Each file's footer is read once per query, however often the query scans it.
        self._table = cache(lambda name: spark.read.parquet(f"{root}/{name}.parquet"))

    # Items -------------------------------------------------------------------------

    def tagged_items(self) -> DataFrame:
        """Items of both splits with their `eval_set`, in one scan. A line of neither split
        is an error, not left out.
        """
        status = F.col("l_linestatus")
        split = (
            F.when(status == "F", PRIOR)
            .when(status == "O", TRAIN)
            .otherwise(F.raise_error(F.concat(F.lit("unknown line status "), status)))
        )
        # The condition is true for every line; it asks for the split also where nothing
        # else does. A NULL status makes a NULL message, which is an error as well.
        lines = self._table("lineitem").withColumn("eval_set", split)
        return lines.where("eval_set IS NOT NULL").select(*_item_columns(dirty=False), "eval_set")

    def _items_of(self, split: str, dirty: bool) -> DataFrame:
        status = {PRIOR: "F", TRAIN: "O"}[split]
        other = ~F.col("l_linestatus").isin("F", "O") | F.col("l_linestatus").isNull()
        unknown = F.raise_error(F.lit("a line of neither split")).cast("boolean")
        lines = self._table("lineitem").where(
            F.when(other, unknown).otherwise(F.col("l_linestatus") == status)
        )
        return lines.select(*_item_columns(dirty))

    def prior_items(self, dirty: bool = False) -> DataFrame:
        return self._items_of(PRIOR, dirty)

    def train_items(self, dirty: bool = False) -> DataFrame:
        return self._items_of(TRAIN, dirty)

    # Orders ------------------------------------------------------------------------

    def order_slots(self, dirty: bool = False) -> DataFrame:
        """Each order's weekday and hour only: nothing that needs a customer's history."""
        slots = _timed(self._table("orders")).select("order_id", "order_dow", "order_hour_of_day")
        return _with_late_copies(slots) if dirty else slots

    def orders(self, dirty: bool = False) -> DataFrame:
        source = self._table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        orders = _timed(_with_history(source)).select(
            "order_id",
            F.col("o_custkey").alias("user_id"),
            F.lit("prior").alias("eval_set"),
            "order_number",
            "order_dow",
            "order_hour_of_day",
            F.datediff("o_orderdate", "previous_date").cast("double").alias(
                "days_since_prior_order"
            ),
        )
        if not dirty:
            return orders
        user = F.when(F.col("order_id") % 101 != 4, F.col("user_id"))
        return _with_late_copies(orders.withColumn("user_id", user))

    # Broken drop -------------------------------------------------------------------

    def broken_item_lines(self, split: str) -> DataFrame:
        """Lines of a CSV file of items with cells that do not parse, lack or are left over."""
        order, product = F.col("order_id").cast("string"), F.col("product_id").cast("string")
        position, flag = (F.col(c).cast("string") for c in ("add_to_cart_order", "reordered"))
        remainder = {n: F.col("order_id") % n for n in (97, 89, 83, 79, 73)}
        line = (
            F.when(remainder[97] == 3, F.concat_ws(",", order, F.lit(""), position, flag))
            .when(remainder[89] == 5, F.concat_ws(",", F.concat(F.lit("x"), order), product, position, flag))
            .when(remainder[83] == 7, F.concat_ws(",", order, product))
            .when(remainder[79] == 11, F.concat_ws(",", order, product, position, flag, F.lit("9")))
            .when(remainder[73] == 13, F.concat_ws(",", order, product, F.lit("n/a"), flag))
            .otherwise(F.concat_ws(",", order, product, position, flag))
        )
        return self._items_of(split, dirty=False).select(line.alias(_header(ITEMS_SCHEMA)))

    def broken_order_lines(self) -> DataFrame:
        """Lines of a CSV file of orders, some repeated, with empty and malformed keys."""
        orders = self.orders(dirty=True)
        number = F.when(F.col("order_id") % 89 == 5, F.concat(F.lit("o"), "order_id"))
        number = F.coalesce(number, F.col("order_id").cast("string"))
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in orders.columns[1:]]
        line = F.concat_ws(",", number, *cells)
        return orders.select(line.alias(_header(ORDERS_SCHEMA)))

    # Dimensions --------------------------------------------------------------------

    def products(self, dirty: bool = False) -> DataFrame:
        products = self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_size").alias("aisle_id"),
            _department_id().alias("department_id"),
        )
        if not dirty:
            return products
        marked = F.array("product_name", F.concat("product_name", F.lit("!")))
        names = F.explode(
            F.when(F.col("product_id") % 10 == 0, marked).otherwise(F.array("product_name"))
        )
        present = products.where(F.col("product_id") % 97 != 0)
        return _with_null_row(present.withColumn("product_name", names))

    def aisles(self, dirty: bool = False) -> DataFrame:
        sizes = self._table("part").select(F.col("p_size").alias("aisle_id")).distinct()
        aisles = sizes.withColumn("aisle", F.concat(F.lit("size "), F.col("aisle_id")))
        return _with_null_row(_twice(aisles)) if dirty else aisles

    def departments(self, dirty: bool = False) -> DataFrame:
        brands = self._table("part").select("p_brand").distinct()
        departments = brands.select(
            _department_id().alias("department_id"), F.col("p_brand").alias("department")
        )
        return _with_null_row(_twice(departments)) if dirty else departments


def _header(schema: str) -> str:
    return ",".join(column.split()[0] for column in schema.split(", "))


def _item_columns(dirty: bool) -> list[Column]:
    product_id = F.col("l_partkey")
    reordered = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    if dirty:
        reordered = F.when(product_id % 83 == 7, 2).otherwise(
            F.when(product_id % 89 != 5, reordered)
        )
        product_id = F.when(F.col("l_orderkey") % 97 != 3, product_id)
    return [
        F.col("l_orderkey").alias("order_id"),
        product_id.alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        reordered.cast("int").alias("reordered"),
    ]


def _department_id() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")


def _timed(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "order_id": F.col("o_orderkey"),
            "order_dow": F.dayofweek("o_orderdate") - 1,
            "order_hour_of_day": (F.col("o_orderkey") % 24).cast("int"),
        }
    )


def _with_late_copies(orders: DataFrame) -> DataFrame:
    hour = F.col("order_hour_of_day")
    twice = F.when(F.col("order_id") % 10 == 0, F.array(hour, F.lit(23)))
    return orders.withColumn("order_hour_of_day", F.explode(F.coalesce(twice, F.array(hour))))


def _twice(rows: DataFrame) -> DataFrame:
    return rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


def _with_null_row(rows: DataFrame) -> DataFrame:
    nothing = rows.sparkSession.range(1).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields)
    )
    return rows.unionByName(nothing)


def _with_history(orders: DataFrame) -> DataFrame:
    """Add `order_number` and `previous_date`: the order's position among its customer's
    orders by (date, key), NULLs first, and the date of the one before it.

    Orders are range-partitioned by (customer, date, key), so a customer with very many
    orders, or the orders without one, spread over as many parts as their rows fill. Orders
    are numbered within a part; what the customer has in earlier parts is added from a table
    with at most a row per part. The ranges are stored, for they are sampled anew each time.
    """
    spark = orders.sparkSession
    by = ["o_custkey", "o_orderdate", "o_orderkey"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "order-ranges")
    ranged = orders.repartitionByRange(width, *by).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)

    within = Window.partitionBy("part", "o_custkey").orderBy("o_orderdate", "o_orderkey")
    numbered = ranged.select(
        *orders.columns,
        "part",
        F.row_number().over(within).alias("position"),
        F.lag("o_orderdate").over(within).alias("date_within"),
    )
    earlier = Window.partitionBy("customer").orderBy("of_part")
    before = (
        ranged.groupBy(F.col("part").alias("of_part"), F.col("o_custkey").alias("customer"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_date"))
        .select(
            "of_part",
            "customer",
            F.sum("n_orders")
            .over(earlier.rowsBetween(Window.unboundedPreceding, -1))
            .alias("orders_before"),
            F.lag("last_date").over(earlier).alias("date_before"),
        )
        .where("orders_before IS NOT NULL")
    )
    # Only the first customer of a part can have orders in an earlier one.
    same = F.col("o_custkey").eqNullSafe(F.col("customer")) & (F.col("part") == F.col("of_part"))
    return numbered.join(F.broadcast(before), same, "left").select(
        *orders.columns,
        (F.col("position") + F.coalesce("orders_before", F.lit(0)))
        .cast("int")
        .alias("order_number"),
        F.when(F.col("position") == 1, F.col("date_before"))
        .otherwise(F.col("date_within"))
        .alias("previous_date"),
    )
