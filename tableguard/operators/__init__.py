"""Operators: check families, history baselines, result reports, loads, freshness."""
