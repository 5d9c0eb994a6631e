"""Scalar functions: URLs, ids, words, HTML, encodings, languages, titles."""
