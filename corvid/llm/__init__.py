"""Operators for preparing training corpora, one module per operator.

Nothing outside this folder (but for ``corpus_pipeline.py``) imports it.
"""
