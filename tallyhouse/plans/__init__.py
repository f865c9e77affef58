"""End-to-end jobs and reports built from the operators."""
