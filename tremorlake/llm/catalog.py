"""All corpus queries, next to the SQL they are compared with."""

from .common import ORACLE, QUERIES
from . import class_lm, cotraining, decontaminate, exact_dedup, fill_middle, html_text, language_id, mixture, near_dedup, pii, suffix_dedup, toxicity, vector_codes  # noqa: F401,E402

__all__ = ["ORACLE", "QUERIES"]
