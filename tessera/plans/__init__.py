"""Composed jobs: the registered query catalogue and the end-to-end pipelines."""
