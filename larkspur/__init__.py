"""Tabular classification data work on Spark: clean, store, encode, split, train, score, publish."""
