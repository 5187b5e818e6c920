"""What the driver contract adds: the numbered operators and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from tollstats.llm import oracle, queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLE = oracle.ORACLE
