"""Bindings to concrete tables, model jobs and the query catalog."""
