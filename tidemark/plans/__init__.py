"""Composed plans: staging, core star schema, marts, consumer reports, ingestion runs and checks."""
