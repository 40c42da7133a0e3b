"""Table contracts: raw file schemas, natural keys, and the typed shape of each mart."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: file names, column names and types of the raw files. -------------

ORDERS_SCHEMA = (
    "order_id INT, user_id INT, eval_set STRING, order_number INT, "
    "order_dow INT, order_hour_of_day INT, days_since_prior_order DOUBLE"
)
ITEMS_SCHEMA = "order_id INT, product_id INT, add_to_cart_order INT, reordered INT"
PRODUCTS_SCHEMA = "product_id INT, product_name STRING, aisle_id INT, department_id INT"
AISLES_SCHEMA = "aisle_id INT, aisle STRING"
DEPARTMENTS_SCHEMA = "department_id INT, department STRING"

ORDERS_FILE = "orders.csv"
PRIOR_ITEMS_FILE = "order_products__prior.csv"
TRAIN_ITEMS_FILE = "order_products__train.csv"

# --- End of fixed values. -----------------------------------------------------------

ITEM_KEYS = ("order_id", "product_id")
# An order without a customer is no order.
ORDER_KEYS = ("order_id", "user_id")
PRIOR, TRAIN = SPLITS = ("prior", "train")


@dataclass(frozen=True)
class Dimension:
    name: str
    file: str
    schema: str
    key: str
    label: str


DIMENSIONS = (
    Dimension("products", "products.csv", PRODUCTS_SCHEMA, "product_id", "product_name"),
    Dimension("aisles", "aisles.csv", AISLES_SCHEMA, "aisle_id", "aisle"),
    Dimension("departments", "departments.csv", DEPARTMENTS_SCHEMA, "department_id", "department"),
)


@dataclass(frozen=True)
class MartContract:
    """Published shape of a mart. Every column is mandatory, `unsigned` ones are >= 0."""

    columns: dict[str, str]
    unsigned: tuple[str, ...]
    sort_by: tuple[str, ...]

    @property
    def has_rate(self) -> bool:
        return "reorder_rate" in self.columns


# --- Fixed values: names, columns and types of the published marts. Unsigned published
# integers take the next Spark type that holds them: 64 bit -> bigint, 32/16/8 bit -> int.
MART_CONTRACTS: dict[str, MartContract] = {
    "mart_department_kpis": MartContract(
        columns={
            "department": "string",
            "n_items": "bigint",
            "n_orders": "bigint",
            "n_products": "bigint",
            "reorder_rate": "double",
            "avg_add_to_cart": "double",
        },
        unsigned=("n_items", "n_orders", "n_products"),
        sort_by=("department",),
    ),
    "mart_aisle_reorder": MartContract(
        columns={
            "aisle": "string",
            "n_items": "bigint",
            "reorder_rate": "double",
            "zscore": "double",
            "is_anomaly": "int",
        },
        unsigned=("n_items", "is_anomaly"),
        sort_by=("aisle",),
    ),
    "mart_product_rank": MartContract(
        columns={
            "department": "string",
            "product_name": "string",
            "n_items": "bigint",
            "rnk": "int",
        },
        unsigned=("n_items", "rnk"),
        sort_by=("department", "rnk"),
    ),
    "mart_hourly_demand": MartContract(
        columns={
            "order_dow": "int",
            "order_hour": "int",
            "n_orders": "bigint",
            "avg_basket_size": "double",
        },
        unsigned=("order_dow", "order_hour", "n_orders"),
        sort_by=("order_dow", "order_hour"),
    ),
    "mart_user_cohort": MartContract(
        columns={
            "order_number": "int",
            "n_orders": "bigint",
            "avg_basket_size": "double",
            "reorder_rate": "double",
        },
        unsigned=("order_number", "n_orders"),
        sort_by=("order_number",),
    ),
}
# --- End of fixed values. -----------------------------------------------------------
