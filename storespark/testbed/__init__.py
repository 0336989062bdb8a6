"""Adapters from the generic test tables to the domain, and the query registry."""
