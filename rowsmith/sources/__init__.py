"""Scans of delimited files, literal and generated rows, and sinks for results."""
