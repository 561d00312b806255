"""Operators and pipeline for building language-model training data.

Nothing outside this folder imports it; ``queries.py`` lists its registered
queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
