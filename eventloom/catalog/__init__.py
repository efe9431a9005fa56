"""All runnable queries; importing this package fills the registry."""

from eventloom.catalog import clicks, evaluation, tables, training, visits  # noqa: F401
from eventloom.catalog.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
