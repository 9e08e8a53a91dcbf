"""Whole analyses: staged layers, and the registered queries with their oracles."""
