"""End-to-end jobs, the model bundle and catalog tables."""
