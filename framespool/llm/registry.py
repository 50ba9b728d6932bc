"""All queries of this subpackage and the SQL of those that SQL can express."""

from importlib import import_module

MODULES = ("url_trust", "pii", "line_dedup", "toxicity", "pieces", "word_dedup", "byte_dedup", "simhash", "lattice", "leaks", "structure", "sketches", "prefix_trie")
QUERIES, SQL = {}, {}
for _name in MODULES:
    _module = import_module(f".{_name}", __package__)
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL

import corpus_pipeline  # noqa: E402

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
