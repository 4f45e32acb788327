"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from oracle.duck import oracle_sql

__all__ = ["oracle_sql"]
