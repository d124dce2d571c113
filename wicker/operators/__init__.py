"""Normalisation, rules, quality, profiling, feasibility and validation."""
