"""Satellite time series as Spark jobs: catalogue, composites, per-pixel series, embeddings."""
