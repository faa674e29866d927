"""SQL that says independently, in DuckDB's dialect, what each registered query should return."""

from oracle.queries import ORACLE

__all__ = ["ORACLE"]
