"""Whole jobs: ingest, cleaning, business questions, screening, price model."""
