"""Analytic tables and pipelines composed from operators."""
