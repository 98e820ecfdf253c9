"""Retrieval question answering as Spark jobs: corpus, search, rerank, scoring, reports."""
