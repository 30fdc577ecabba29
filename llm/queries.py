"""All queries of this package, with the corpus pipeline."""

import corpus_pipeline
from llm import (  # noqa: F401  (these register their queries)
    bpe, chat, embeddings, minhash, packing, quality, resampling, secretscan, sharding, substring, toxicity, veccodes, warc)
from llm.registry import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
