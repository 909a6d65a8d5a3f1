"""Data-quality checks: one row per checked column or rule, and reports over them."""
