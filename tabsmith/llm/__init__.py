"""Operators for preparing large training corpora (numbered op1 to op13).

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
