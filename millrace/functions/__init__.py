"""Scalar and aggregate helpers, all Column in and Column out."""

from millrace.functions import analyse, booleans, dates, numbers, strings

__all__ = ["analyse", "booleans", "dates", "numbers", "strings"]
