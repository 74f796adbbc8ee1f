"""The registered queries of this subpackage and, where SQL can tell, the same results as SQL."""

from __future__ import annotations

from evalflow.llm import bpe, collocations, editprint, jaccard, lexical, licenses, mixing, packing, pii, rules, tokenfiles, toxicity, warc

_MODULES = (jaccard, packing, bpe, toxicity, warc, pii, mixing, tokenfiles, editprint, rules, licenses, lexical, collocations)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in getattr(module, "SQL", {}).items()}
