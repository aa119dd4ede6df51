"""Operators from DataFrame to DataFrame, and fitted objects that hold what they learn."""
