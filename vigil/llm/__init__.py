"""Operators of a training-data pipeline: search, chat logs, fingerprints,
language, line dedup, mixing, toxicity, near-duplicate join, WARC, packing,
centroids, embedding near-duplicates and conversation tries.

Nothing outside this package imports it; ``vigil.llm.queries`` holds the
registered queries and their SQL.
"""
