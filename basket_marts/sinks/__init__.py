"""Where results go: lake files, published marts, metrics, nowhere (timing)."""

from basket_marts.sinks.files import run_to_nowhere, write_compact, write_even, write_json, write_natural
from basket_marts.sinks.publish import publish_mart, to_catalog, to_jdbc, to_parquet

__all__ = [
    "publish_mart",
    "run_to_nowhere",
    "to_catalog",
    "to_jdbc",
    "to_parquet",
    "write_compact",
    "write_even",
    "write_json",
    "write_natural",
]
