"""Operations for large text corpora: extraction, scans, dedup, tokens, packing, search.

Nothing else in the library imports this subpackage.
"""
