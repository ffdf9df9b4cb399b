"""Composed jobs: the query registry, its SQL oracles and the pipelines."""
