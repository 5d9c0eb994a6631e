"""Whole plans: the document pipeline, its plugins, sinks and command line."""
