"""Training-data operators: filtering, de-duplication, decontamination, tokenisation and packing of a text corpus.

Every operator is a function ``DataFrame (+ parameters) -> DataFrame``; ``queries.py`` binds them to the given tables.
Nothing outside this subpackage imports it.
"""
