"""Declared schemas, end-to-end stages, and the registered queries with their SQL."""
