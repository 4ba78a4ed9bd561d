"""Queries and oracles of the corpus operators."""

from __future__ import annotations

import corpus_pipeline
from orderlens.llm import (bpe, codes, decontaminate, divergence, kmers, packing, pii, quality, secrets, shards, simhash,
                           suffixes, tokencount)

MODULES = (quality, kmers, simhash, suffixes, shards, decontaminate, secrets, tokencount, pii, bpe, packing, divergence,
           codes)


def all_queries():
    found = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
    return found | {"pipeline": corpus_pipeline.run}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
