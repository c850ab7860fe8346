"""Queries of the corpus operators and their SQL twins, for the entry file."""

from periodica.llm import (
    exact_dedup,
    filter_audit,
    fingerprints,
    langid,
    lm_scoring,
    mixing,
    near_dedup,
    pii,
    prefix_trie,
    secrets,
    suffix_dedup,
    tokens,
    toxicity,
)

MODULES = [
    secrets,
    near_dedup,
    toxicity,
    mixing,
    fingerprints,
    pii,
    tokens,
    exact_dedup,
    langid,
    suffix_dedup,
    prefix_trie,
    lm_scoring,
    filter_audit,
]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
