"""Query keys over the test tables: each is a Spark DataFrame function plus
the same result written as DuckDB SQL (the correctness oracle)."""

from .registry import QUERIES, ORACLE  # noqa: F401
from . import (q_sources, q_steps, q_compare, q_scd, q_dims, q_late, q_cdc,  # noqa: F401
               q_quality, q_audit, q_functions, q_streams, q_loads)
