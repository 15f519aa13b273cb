"""Operators for training data and entity matching: problems 1 and 3 to 10. Nothing else in the library imports this subpackage."""

from mergetide.llm import addresses, linkage, mixing, places, reading, survivorship, tokenize, topn, variants

MODULES = [linkage, variants, topn, places, addresses, survivorship, tokenize, mixing, reading]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in MODULES for k, s in m.ORACLES.items()}
