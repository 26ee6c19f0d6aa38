"""Operators for large text corpora: filters, joins, search, classifiers, tokens, main text."""
