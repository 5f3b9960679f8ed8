"""Typed ingest, running totals, current tables and reports for shop events, on Spark."""
