"""Relational operators composed from DataFrame operations."""
from millrace.operators.ordered import in_order

__all__ = ["in_order"]
