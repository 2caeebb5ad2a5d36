"""Inputs: message logs, the raw lake, and the benchmark tables."""
