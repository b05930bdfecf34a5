"""Scalar parse and coercion rules (SQL-text builders and Column wrappers)."""
