"""Readers: object listings, archives, line-delimited JSON, external tables."""
