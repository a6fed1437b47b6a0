"""Reusable DataFrame operators: ranking, lookups, upserts, rules."""
