"""Items and orders bucketed by order, so that baskets and their orders meet without a shuffle.

The bucket columns are the order and a salt. Items of an order that is too large for one task
(`spark.basketmarts.rowsPerSplit`) have as many salts as it needs, so its rows lie in several
buckets; all others, and all orders, have salt 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.functions import ratio
from basket_marts.operators import heavy_keys
from basket_marts.session import remove_folder

BUCKET_BY = ("order_id", "salt")


@dataclass(frozen=True)
class ColocatedTables:
    """Catalog tables `items`, `orders` and `heavy_orders` of a database, files below `location`."""

    spark: SparkSession
    database: str
    location: str
    buckets: int

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def _save(self, rows: DataFrame, name: str, bucketed: bool) -> None:
        path = f"{self.location}/{name}"
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
        remove_folder(self.spark, path)
        target = rows.write.format("parquet").option("path", path)
        if bucketed:
            target = target.bucketBy(self.buckets, *BUCKET_BY).sortBy(*BUCKET_BY)
        target.saveAsTable(self._name(name))

    def write(self, items: DataFrame, orders: DataFrame) -> None:
        """Replace the tables. The shuffle that a query saves later is paid here, once; each
        bucket is one file, written by one task.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        # At most one order for each `rowsPerSplit` items.
        self._save(heavy_keys(items, "order_id"), "heavy_orders", bucketed=False)
        heavy = F.broadcast(self.table("heavy_orders"))
        spread = F.pmod(F.xxhash64("product_id"), F.coalesce("splits", F.lit(1))).cast("int")
        salted = items.join(heavy, "order_id", "left").withColumn("salt", spread).drop("splits")
        self._save(salted.repartition(self.buckets, *BUCKET_BY), "items", bucketed=True)
        unsalted = orders.withColumn("salt", F.lit(0))
        self._save(unsalted.repartition(self.buckets, *BUCKET_BY), "orders", bucketed=True)

    def _partial_baskets(self) -> DataFrame:
        return self.table("items").groupBy(*BUCKET_BY).agg(
            F.count(F.lit(1)).alias("basket_size"),
            F.sum("reordered").alias("reordered_sum"),
            F.count("reordered").alias("reordered_known"),
        )

    def orders_with_baskets(self) -> DataFrame:
        """`marts.orders_with_baskets`, all orders with their basket, NULL without items.

        Neither the items' aggregation nor the join shuffles. Only where there are orders of
        several salts, their partial baskets, one row for each salt, are summed and broadcast.
        """
        sums = ("basket_size", "reordered_sum", "reordered_known")
        orders = self.table("orders").join(self._partial_baskets(), list(BUCKET_BY), "left")
        heavy = self.table("heavy_orders")
        if not heavy.isEmpty():
            pieces = self._partial_baskets().join(F.broadcast(heavy.select("order_id")), "order_id", "left_semi")
            whole = pieces.groupBy("order_id").agg(F.struct(*(F.sum(c).alias(c) for c in sums)).alias("whole"))
            orders = orders.join(F.broadcast(whole), "order_id", "left").withColumns(
                {c: F.coalesce(F.col("whole").getField(c), F.col(c)) for c in sums}
            )
        rate = ratio(F.col("reordered_sum"), F.col("reordered_known"))
        kept = [c for c in self.table("orders").columns if c != "salt"]
        return orders.select(*kept, "basket_size", rate.alias("order_reorder_rate"))
