"""Corpus preparation operators (near-dedup, PII, packing, tokens, archives ...).

Nothing outside this package imports it.
"""
