"""Whole jobs, composed from the sources, operators and sinks."""
