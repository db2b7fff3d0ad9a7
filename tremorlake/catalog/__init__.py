"""Registered queries: each operator over the whole test tables, with its SQL where there is one."""

from .registry import ORACLE, QUERIES
from . import detection, evaluation, features, learning, readings, statistics, streams, windows  # noqa: F401,E402

__all__ = ["ORACLE", "QUERIES"]
