"""Registered queries over the supplied tables, and the same results as plain SQL."""
