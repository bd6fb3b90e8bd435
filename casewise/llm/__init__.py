"""Operators for preparing training data from large text corpora.

Nothing else in the library imports this subpackage.  ``queries.py`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
