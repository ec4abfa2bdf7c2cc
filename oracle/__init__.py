"""The registered queries once more, as plain SQL for an independent check."""

from oracle.queries import oracle_sql

__all__ = ["oracle_sql"]
