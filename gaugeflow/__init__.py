"""Observation ingest and reconciliation as Spark jobs."""
