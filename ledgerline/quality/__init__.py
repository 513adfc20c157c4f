"""Data-quality checks: failing rows, counts, severities and the suite for every table."""
