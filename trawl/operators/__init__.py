"""Relational operators: filters, links, lookups, signals, graphs, search."""
