"""Corpus operators for training-data pipelines, one module each; ``queries`` registers them on the driver tables."""
