"""Operators and one pipeline for preparing text corpora for language-model training."""
