"""The same queries as ANSI SQL for DuckDB, over the same Parquet tables."""

from __future__ import annotations

from basket_marts.plans import quality
from basket_marts.schemas import MART_CONTRACTS

# Shared tables as raw basket tables ---------------------------------------------------

_CTE = {
    "raw_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               l_linenumber AS add_to_cart_order,
               CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS reordered,
               CASE l_linestatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train'
                    ELSE error('a line of neither split') END AS eval_set
        FROM lineitem""",
    "items": """
        SELECT order_id, product_id, add_to_cart_order, reordered, eval_set
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id, product_id
                  ORDER BY eval_set, add_to_cart_order, reordered) AS copy FROM raw_items)
        WHERE copy = 1""",
    "dirty_items": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_orderkey % 97 = 3 THEN NULL ELSE l_partkey END AS product_id,
               l_linenumber AS add_to_cart_order,
               CAST(CASE WHEN l_partkey % 83 = 7 THEN 2 WHEN l_partkey % 89 = 5 THEN NULL
                    WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS reordered,
               CASE l_linestatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train'
                    ELSE error('a line of neither split') END AS eval_set
        FROM lineitem""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, 'prior' AS eval_set,
               CAST(row_number() OVER customer AS INT) AS order_number,
               CAST(dayofweek(o_orderdate) AS INT) AS order_dow,
               CAST(o_orderkey % 24 AS INT) AS order_hour_of_day,
               CAST(date_diff('day', lag(o_orderdate) OVER customer, o_orderdate) AS DOUBLE)
                   AS days_since_prior_order
        FROM orders
        WINDOW customer AS (PARTITION BY o_custkey
            ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST)""",
    "dirty_orders": """
        SELECT order_id, CASE WHEN order_id % 101 = 4 THEN NULL ELSE user_id END AS user_id,
               eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order
        FROM (SELECT * FROM raw_orders UNION ALL
              SELECT * REPLACE (CAST(23 AS INT) AS order_hour_of_day)
              FROM raw_orders WHERE order_id % 10 = 0)""",
    "broken_items": """
        SELECT eval_set AS split, order_id, product_id, add_to_cart_order, reordered,
               CASE WHEN order_id % 97 = 3 THEN 'missing key'
                    WHEN order_id % 89 = 5 THEN 'malformed record' END AS reason,
               CASE WHEN order_id % 97 = 3 THEN concat_ws(',', order_id, '', add_to_cart_order, reordered)
                    ELSE concat_ws(',', 'x' || order_id, product_id, add_to_cart_order, reordered)
                    END AS record,
               order_id % 83 = 7 OR order_id % 79 = 11 OR order_id % 73 = 13 AS is_odd
        FROM raw_items""",
    "broken_orders": """
        SELECT *, CASE WHEN order_id % 89 = 5 THEN 'malformed record'
                       WHEN user_id IS NULL THEN 'missing key' END AS reason,
               concat_ws(',', CASE WHEN order_id % 89 = 5 THEN 'o' ELSE '' END || order_id,
                   coalesce(CAST(user_id AS VARCHAR), ''), eval_set, order_number, order_dow,
                   order_hour_of_day, coalesce(CAST(days_since_prior_order AS VARCHAR), '')) AS record
        FROM dirty_orders""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_size AS aisle_id,
               CAST(regexp_extract(p_brand, '[0-9]+') AS INT) AS department_id
        FROM part""",
    "dirty_products": """
        SELECT * FROM products WHERE product_id % 97 <> 0
        UNION ALL
        SELECT product_id, product_name || '!', aisle_id, department_id
        FROM products WHERE product_id % 97 <> 0 AND product_id % 10 = 0
        UNION ALL
        SELECT NULL, NULL, NULL, NULL""",
    "aisles": """
        SELECT DISTINCT p_size AS aisle_id, 'size ' || CAST(p_size AS VARCHAR) AS aisle
        FROM part""",
    "departments": """
        SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS INT) AS department_id,
               p_brand AS department
        FROM part""",
    # Shared steps -------------------------------------------------------------------
    "enriched": """
        SELECT order_id, product_id, add_to_cart_order, reordered, eval_set, product_name,
               aisle_id, department_id, aisle, department
        FROM items JOIN products USING (product_id)
        JOIN departments USING (department_id) JOIN aisles USING (aisle_id)""",
    "baskets": """
        SELECT order_id, count(*) AS basket_size, avg(reordered) AS order_reorder_rate
        FROM items GROUP BY order_id""",
    "ordered": """
        SELECT o.*, b.basket_size, b.order_reorder_rate
        FROM raw_orders o LEFT JOIN baskets b USING (order_id)""",
    "aisle_rate": """
        SELECT aisle, count(*) AS n_items, round(avg(reordered), 4) AS reorder_rate
        FROM enriched GROUP BY aisle""",
    # Marts --------------------------------------------------------------------------
    "mart_department_kpis": """
        SELECT department, count(*) AS n_items, count(DISTINCT order_id) AS n_orders,
               count(DISTINCT product_id) AS n_products,
               round(avg(reordered), 4) AS reorder_rate,
               round(avg(add_to_cart_order), 2) AS avg_add_to_cart
        FROM enriched GROUP BY department""",
    "mart_aisle_reorder": """
        SELECT *, CAST(abs(zscore) > 2 AS INT) AS is_anomaly
        FROM (SELECT aisle, n_items, reorder_rate,
                     round((reorder_rate - (SELECT avg(reorder_rate) FROM aisle_rate))
                         / (SELECT nullif(stddev_samp(reorder_rate), 0) FROM aisle_rate), 3)
                         AS zscore
              FROM aisle_rate)""",
    "mart_product_rank": """
        SELECT department, product_name, n_items, rnk
        FROM (SELECT department, product_name, count(*) AS n_items,
                     CAST(row_number() OVER (PARTITION BY department
                         ORDER BY count(*) DESC, product_name) AS INT) AS rnk
              FROM enriched GROUP BY department, product_name)
        WHERE rnk <= 10""",
    "mart_hourly_demand": """
        SELECT order_dow, order_hour_of_day AS order_hour,
               count(DISTINCT order_id) AS n_orders,
               round(avg(basket_size), 2) AS avg_basket_size
        FROM ordered GROUP BY order_dow, order_hour_of_day""",
    "mart_user_cohort": """
        SELECT least(order_number, 30) AS order_number,
               count(DISTINCT order_id) AS n_orders,
               round(avg(basket_size), 2) AS avg_basket_size,
               round(avg(order_reorder_rate), 4) AS reorder_rate
        FROM ordered GROUP BY least(order_number, 30)""",
}

_NEEDS = {
    "items": ["raw_items"],
    "dirty_orders": ["raw_orders"],
    "dirty_products": ["products"],
    "broken_items": ["raw_items"],
    "broken_orders": ["dirty_orders"],
    "enriched": ["items", "products", "departments", "aisles"],
    "baskets": ["items"],
    "ordered": ["raw_orders", "baskets"],
    "aisle_rate": ["enriched"],
    "mart_department_kpis": ["enriched"],
    "mart_aisle_reorder": ["aisle_rate"],
    "mart_product_rank": ["enriched"],
    "mart_hourly_demand": ["ordered"],
    "mart_user_cohort": ["ordered"],
}


def _sql(select: str, *needs: str) -> str:
    """Prefix `select` with the common table expressions it needs, each once."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for earlier in _NEEDS.get(name, []):
            add(earlier)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_CTE[name]})" for name in ordered)
    return f"WITH {ctes}\n{select}"


def _all(name: str) -> str:
    return _sql(f"SELECT * FROM {name}", name)


def _batch(select: str) -> str:
    """`select` over the marts and cleaned tables of a batch that starts from the dirty view.

    The cleaned tables take the place of the plain ones that the marts are defined over.
    """
    cleaned = {
        "items": ORACLE["clean_order_products"],
        "raw_orders_kept": ORACLE["clean_orders"],
        "products": f"""
            SELECT product_id, min(product_name) AS product_name,
                   min(aisle_id) AS aisle_id, min(department_id) AS department_id
            FROM ({_sql("SELECT * FROM dirty_products", "dirty_products")})
            WHERE product_id IS NOT NULL GROUP BY product_id""",
    }
    later = ["aisles", "departments", "enriched", "baskets", "ordered", "aisle_rate"]
    steps = cleaned | {name: _CTE[name] for name in [*later, *MART_CONTRACTS]}
    steps["ordered"] = steps["ordered"].replace("raw_orders", "raw_orders_kept")
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())
    return f"WITH {ctes}\n{select}"


def _first_copy(source: str, keys: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS copy
        FROM {source}) WHERE copy = 1"""


def _checks(*rows: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, v = 0 AS ok, v AS violations "
        f"FROM (SELECT CAST(({count}) AS BIGINT) AS v)"
        for name, count in rows
    )


def _table_checks(items: str, orders: str, products: str) -> list[tuple[str, str]]:
    distinct = "SELECT DISTINCT"
    return [
        (
            quality.ITEM_KEYS_PRESENT,
            f"SELECT count(*) FROM {items} WHERE order_id IS NULL OR product_id IS NULL",
        ),
        (
            quality.ORDER_ID_UNIQUE,
            f"SELECT (SELECT count(*) FROM {orders}) - "
            f"(SELECT count(*) FROM ({distinct} order_id FROM {orders}))",
        ),
        (
            quality.ITEM_KEYS_UNIQUE,
            f"SELECT (SELECT count(*) FROM {items}) - "
            f"(SELECT count(*) FROM ({distinct} order_id, product_id FROM {items}))",
        ),
        (
            quality.REORDERED_DOMAIN,
            f"SELECT count(*) FROM {items} WHERE reordered NOT IN (0, 1)",
        ),
        (
            quality.PRODUCT_EXISTS,
            f"SELECT count(*) FROM {items} i WHERE NOT EXISTS "
            f"(SELECT 1 FROM {products} p WHERE p.product_id = i.product_id)",
        ),
    ]


def _mart_checks() -> list[tuple[str, str]]:
    rows = []
    for mart, contract in MART_CONTRACTS.items():
        rows.append(
            (
                quality.MART_NOT_EMPTY.format(mart=mart),
                f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {mart}",
            )
        )
        if contract.has_rate:
            rows.append(
                (
                    quality.MART_RATE_RANGE.format(mart=mart),
                    f"SELECT count(*) FROM {mart} WHERE reorder_rate < 0 OR reorder_rate > 1",
                )
            )
    return rows


def _dimension(name: str, key: str, label: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS dimension, CAST({key} AS BIGINT) AS id, min({label}) AS name "
        f"FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"
    )


def _hours() -> str:
    return ", ".join(
        f"CAST(coalesce(sum(n_orders) FILTER (order_hour = {h}), 0) AS BIGINT) AS h{h}"
        for h in range(24)
    )


_JOIN_COUNT = _sql(
    "SELECT department_id, count(*) AS n_items FROM items JOIN products USING (product_id) "
    "GROUP BY department_id",
    "items",
    "products",
)

ORACLE: dict[str, str] = {
    "clean_order_products": _sql(
        _first_copy(
            "(SELECT * REPLACE (coalesce(reordered, 0) AS reordered) FROM dirty_items "
            "WHERE order_id IS NOT NULL AND product_id IS NOT NULL)",
            "order_id, product_id",
            "eval_set, add_to_cart_order, reordered",
            "order_id, product_id, add_to_cart_order, reordered, eval_set",
        ),
        "dirty_items",
    ),
    "clean_orders": _sql(
        _first_copy(
            "(SELECT * FROM dirty_orders WHERE order_id IS NOT NULL AND user_id IS NOT NULL)",
            "order_id",
            "user_id, eval_set, order_number, order_dow, order_hour_of_day, "
            "days_since_prior_order NULLS FIRST",
            "order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, "
            "days_since_prior_order",
        ),
        "dirty_orders",
    ),
    "clean_dimensions": _sql(
        "\nUNION ALL\n".join(
            (
                _dimension("products", "product_id", "product_name", "dirty_products"),
                _dimension("aisles", "aisle_id", "aisle", "aisles"),
                _dimension("departments", "department_id", "department", "departments"),
            )
        ),
        "dirty_products",
        "aisles",
        "departments",
    ),
    "enrich_items": _all("enriched"),
    "mart_department_kpis": _all("mart_department_kpis"),
    "aisle_rate_stats": _sql(
        "SELECT round(avg(reorder_rate), 12) AS mean_rate, "
        "round(stddev_samp(reorder_rate), 12) AS stddev_rate FROM aisle_rate",
        "aisle_rate",
    ),
    "mart_aisle_reorder": _all("mart_aisle_reorder"),
    "mart_product_rank": _all("mart_product_rank"),
    "order_baskets": _all("baskets"),
    "orders_with_baskets": _all("ordered"),
    "mart_hourly_demand": _all("mart_hourly_demand"),
    "mart_user_cohort": _all("mart_user_cohort"),
    "mart_user_cohort_cap10": _sql(
        "SELECT least(order_number, 10) AS order_number, count(DISTINCT order_id) AS n_orders, "
        "round(avg(basket_size), 2) AS avg_basket_size, "
        "round(avg(order_reorder_rate), 4) AS reorder_rate "
        "FROM ordered GROUP BY least(order_number, 10)",
        "ordered",
    ),
    "orphan_items": _sql(
        "SELECT order_id, product_id, add_to_cart_order, reordered, eval_set FROM items i "
        "WHERE NOT EXISTS (SELECT 1 FROM products p "
        "WHERE p.product_id = i.product_id AND p.product_id % 97 <> 0)",
        "items",
        "products",
    ),
    "dq_report": _sql(
        _checks(*_table_checks("items", "raw_orders", "products"), *_mart_checks()),
        *MART_CONTRACTS,
    ),
    "dq_report_dirty": _sql(
        _checks(*_table_checks("dirty_items", "dirty_orders", "dirty_products")),
        "dirty_items",
        "dirty_orders",
        "dirty_products",
    ),
    **{name.replace("mart_", "published_"): _all(name) for name in MART_CONTRACTS},
    "hourly_pivot": _sql(
        f"SELECT order_dow, {_hours()} FROM mart_hourly_demand GROUP BY order_dow",
        "mart_hourly_demand",
    ),
    "departments_by_rate": _sql(
        "SELECT department, reorder_rate FROM mart_department_kpis "
        "ORDER BY reorder_rate DESC, department",
        "mart_department_kpis",
    ),
    "join_shuffle": _JOIN_COUNT,
    "join_preaggregated": _JOIN_COUNT,
    "join_broadcast": _JOIN_COUNT,
    "reordered_counts": _sql(
        "SELECT reordered, count(*) AS n_items FROM items GROUP BY reordered", "items"
    ),
    "csv_scan_counts": _sql(
        "SELECT reordered, count(*) AS n_items FROM raw_items GROUP BY reordered", "raw_items"
    ),
    "key_skew": _sql(
        "SELECT max(c) AS max_rows, CAST(quantile_disc(c, 0.5) AS BIGINT) AS median_rows, "
        "round(max(c) / CAST(quantile_disc(c, 0.5) AS DOUBLE), 1) AS max_to_median "
        "FROM (SELECT count(*) AS c FROM items GROUP BY product_id)",
        "items",
    ),
}

ORACLE["published_user_cohort"] = ORACLE["mart_user_cohort_cap10"]
ORACLE["lake_row_counts"] = _batch(
    "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, count(*) AS n_rows FROM {source}"
        for table, source in (
            ("products", "products"),
            ("aisles", "aisles"),
            ("departments", "departments"),
            ("orders", "raw_orders_kept"),
            ("order_products", "items"),
        )
    )
)
ORACLE["batch_marts"] = _batch(
    "\nUNION ALL\n".join(
        f"SELECT '{mart}' AS mart, {key} AS key, {n} AS n, CAST({figure} AS DOUBLE) AS figure FROM {mart}"
        for mart, key, n, figure in (
            ("mart_department_kpis", "department", "n_orders", "reorder_rate"),
            ("mart_aisle_reorder", "aisle", "n_items", "zscore"),
            (
                "mart_product_rank",
                "department || ' ' || CAST(rnk AS VARCHAR) || ' ' || product_name",
                "n_items",
                "NULL",
            ),
            (
                "mart_hourly_demand",
                "CAST(order_dow AS VARCHAR) || ' ' || CAST(order_hour AS VARCHAR)",
                "n_orders",
                "avg_basket_size",
            ),
            ("mart_user_cohort", "CAST(order_number AS VARCHAR)", "n_orders", "reorder_rate"),
        )
    )
)
ORACLE["dq_report_lake"] = _batch(
    _checks(*_table_checks("items", "raw_orders_kept", "products"), *_mart_checks())
)


# Accounting, late drops, states: what comes out as if everything had been done at once --------

ORACLE["csv_rejects"] = _sql(
    """
    SELECT 'order_products' AS table_name, split, reason, record
    FROM broken_items WHERE reason IS NOT NULL
    UNION ALL
    SELECT 'orders', NULL, reason, record FROM broken_orders WHERE reason IS NOT NULL""",
    "broken_items",
    "broken_orders",
)


def _account(table: str, source: str, key: str, rejected: str, damaged: str) -> str:
    kept = f"count(DISTINCT {key}) FILTER (NOT ({rejected}))"
    return f"""
        SELECT '{table}' AS table_name, count(*) AS rows_read, {kept} AS kept,
               count(*) FILTER (NOT ({rejected})) - {kept} AS duplicates,
               count(*) FILTER ({rejected}) AS rejected,
               count(*) FILTER (NOT ({rejected}) AND {damaged}) AS damaged
        FROM {source}"""


_TWICE = "(SELECT * FROM {0} UNION ALL SELECT * FROM {0} UNION ALL SELECT NULL, NULL)"
ORACLE["csv_accounts"] = _sql(
    "\nUNION ALL\n".join(
        (
            _account("products", "dirty_products", "product_id", "product_id IS NULL", "false"),
            _account("aisles", _TWICE.format("aisles"), "aisle_id", "aisle_id IS NULL", "false"),
            _account(
                "departments", _TWICE.format("departments"), "department_id", "department_id IS NULL", "false"
            ),
            _account("orders", "broken_orders", "order_id", "reason IS NOT NULL", "false"),
            _account(
                "order_products", "broken_items", "(order_id, product_id)", "reason IS NOT NULL", "is_odd"
            ),
        )
    ),
    "dirty_products",
    "aisles",
    "departments",
    "broken_orders",
    "broken_items",
)
ORACLE["csv_split_counts"] = _sql(
    "SELECT eval_set, reordered, count(*) AS n_items FROM raw_items GROUP BY ALL", "raw_items"
)
ORACLE["merged_items"] = ORACLE["clean_order_products"]
ORACLE["rerun_weekday"] = (
    "SELECT * REPLACE (CASE WHEN order_dow = 3 THEN order_hour_of_day ELSE 0 END AS order_hour_of_day) "
    f"FROM ({ORACLE['clean_orders']})"
)
ORACLE["rerun_weekday_demand"] = (
    "SELECT order_dow, order_hour_of_day AS order_hour, count(*) AS n_orders "
    f"FROM ({ORACLE['clean_orders']}) WHERE order_dow = 3 GROUP BY ALL"
)
ORACLE["merged_department_orders"] = _sql(
    "SELECT department, n_orders FROM mart_department_kpis", "mart_department_kpis"
)
ORACLE["incremental_department_kpis"] = ORACLE["mart_department_kpis"]
ORACLE["incremental_aisle_reorder"] = ORACLE["mart_aisle_reorder"]
ORACLE["incremental_hourly_demand"] = ORACLE["mart_hourly_demand"]
ORACLE["key_skew_sketch"] = _sql(
    "SELECT count(*) AS n_keys, max(c) AS max_rows, "
    "CAST(quantile_disc(c, 0.5) AS BIGINT) AS median_rows, true AS within_bound "
    "FROM (SELECT count(*) AS c FROM items GROUP BY product_id)",
    "items",
)

ORACLE["published_catalog_department_kpis"] = ORACLE["mart_department_kpis"]
ORACLE["published_catalog_product_rank"] = ORACLE["mart_product_rank"]
ORACLE["colocated_orders_with_baskets"] = ORACLE["orders_with_baskets"]


def _size_figures(run: str, where: str) -> str:
    counts = f"(SELECT count(*) AS c FROM items WHERE {where} GROUP BY product_id)"
    return f"""
        SELECT '{run}' AS run, unnest(['rows_order_products', 'skew_product_id_max_rows',
                   'skew_product_id_median_rows', 'skew_ratio_max_to_median']) AS figure,
               unnest([CAST(sum(c) AS DOUBLE), CAST(max(c) AS DOUBLE), quantile_disc(c, 0.5),
                       round(max(c) / CAST(quantile_disc(c, 0.5) AS DOUBLE), 1)]) AS value
        FROM {counts}"""


ORACLE["metrics_history"] = _sql(
    "SELECT run, figure, value, previous, round((value - previous) / previous, 4) AS change FROM ("
    "SELECT *, lag(value) OVER (PARTITION BY figure ORDER BY run) AS previous FROM ("
    f"{_size_figures('run 1', "eval_set = 'prior'")} UNION ALL {_size_figures('run 2', 'true')}))",
    "items",
)
ORACLE["batch_stage_rows"] = _sql(
    "\nUNION ALL\n".join(
        [
            f"SELECT '{stage}' AS stage, '{output}' AS output, count(*) AS n_rows FROM {source}"
            for stage, output, source in (
                ("clean", "products", "products"),
                ("clean", "aisles", "aisles"),
                ("clean", "departments", "departments"),
                ("clean", "orders", "raw_orders"),
                ("clean", "order_products", "items"),
                *(("marts", mart, mart) for mart in MART_CONTRACTS),
            )
        ]
        + ["SELECT 'checks', 'passed', 13"]
    ),
    *MART_CONTRACTS,
)
