"""Imports every query module so the registry is complete."""

from tillroll.plans import io_queries, job_queries, mart_queries, state_queries  # noqa: F401
from tillroll.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
