"""tripmart: monthly trip analytics as Spark jobs.

Raw trip files go through bronze (typed), staging (filtered), silver (keyed and
enriched) and gold (star schema and aggregates), gated by data-quality rules
and recorded in a run log.  See README.md for a tour.
"""
