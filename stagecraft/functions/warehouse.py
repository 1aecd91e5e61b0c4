"""Cluster size names -> node count, used by the batch size advice."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Size names (matched case-insensitively) and node counts.
NODES_BY_SIZE = {
    "X-SMALL": 1, "XSMALL": 1, "XS": 1,
    "SMALL": 2, "S": 2,
    "MEDIUM": 4, "M": 4,
    "LARGE": 8, "L": 8,
    "X-LARGE": 16, "XLARGE": 16, "XL": 16,
    "2X-LARGE": 32, "2XLARGE": 32, "2XL": 32,
    "3X-LARGE": 64, "3XLARGE": 64, "3XL": 64,
    "4X-LARGE": 128, "4XLARGE": 128, "4XL": 128,
    "5X-LARGE": 256, "5XLARGE": 256, "5XL": 256,
    "6X-LARGE": 512, "6XLARGE": 512, "6XL": 512,
}

CORES_PER_NODE = 8


def nodes_per_warehouse(size: Column | str) -> Column:
    """Node count for a size name; unknown names and null give null."""
    c = F.upper(F.col(size) if isinstance(size, str) else size)
    expr = None
    for name, nodes in NODES_BY_SIZE.items():
        expr = F.when(c == name, F.lit(nodes)) if expr is None else expr.when(c == name, F.lit(nodes))
    return expr


def nodes_per_warehouse_sql(size_sql: str) -> str:
    whens = " ".join(f"when '{name}' then {nodes}" for name, nodes in NODES_BY_SIZE.items())
    return f"case upper({size_sql}) {whens} else null end"


def nodes_for(size: str) -> int | None:
    """Driver-side lookup for argument values."""
    return NODES_BY_SIZE.get(size.upper()) if size is not None else None
