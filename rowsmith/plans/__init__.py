"""End-to-end jobs and the catalog of checked queries."""
