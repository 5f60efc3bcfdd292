"""Corpus operators: work on tables of documents for training data."""
