"""Imports every query module, so that the registry is complete."""

from trackflow.catalog import cleaning, detection, operations, serving, streams  # noqa: F401
from trackflow.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
