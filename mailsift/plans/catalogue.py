"""All registered queries. Importing a module registers what it defines."""

from mailsift.plans import curation_queries, evaluation_queries, model_queries, text_queries, vector_queries  # noqa: F401
from mailsift.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
