"""Operators for preparing language-model training data.

One module per operator, each with a general interface (DataFrame in,
DataFrame out) and a thin registered query in ``queries.py``. Nothing outside
this folder (and ``corpus_pipeline.py``) imports it.
"""
