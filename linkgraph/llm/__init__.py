"""Operators for preparing training data, each a Spark job of its own.

Nothing else in the library imports this package. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
