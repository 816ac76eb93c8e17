"""Registered queries, one module per family."""
from tidewater.plans.registry import ORACLE, QUERIES, load_all

__all__ = ["ORACLE", "QUERIES", "load_all"]
