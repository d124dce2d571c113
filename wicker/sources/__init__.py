"""Delimited files with a checked contract, and atomic publication."""
