"""Composed jobs: airport dimension clean-up, weather requests, training table,
model selection, batch scoring, day ingest."""
