"""All queries and SQL of the training-data operators."""

from __future__ import annotations

from framewright.llm import decontamination, langid, licenses, linededup, mixing, quality, sharding, simhash, tokencount, tokenfiles

MODULES = [linededup, langid, tokencount, simhash, licenses, sharding, decontamination, quality, tokenfiles, mixing]

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
