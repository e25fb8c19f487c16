"""Operators: DataFrame in, DataFrame out, keyed by service_date."""
