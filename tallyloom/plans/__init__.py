"""Composed queries: views, dashboard queries and multi-stage runs."""
