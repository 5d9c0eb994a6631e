"""Training-data operators: deduplication, cleaning, mixing, token output, scoring.

Nothing outside this subpackage imports it.
"""
