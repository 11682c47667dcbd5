"""Whole queries: each takes (spark, sf_dir)."""
from millrace.plans.walkthrough import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
