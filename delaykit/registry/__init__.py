"""

Each key maps to ``fn(spark, sf_dir) -> DataFrame`` and, when the result is
SQL-expressible, an equivalent DuckDB query over the same tables.
"""

from delaykit.registry.base import ORACLE, QUERIES  # noqa: F401
from delaykit.registry import (  # noqa: F401  (modules register their keys on import)
    scans, files, filters, joins, profile, dedup, scalar, nested, checks, model, streams,
)
