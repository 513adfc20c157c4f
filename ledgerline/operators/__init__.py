"""Reusable DataFrame operators that know nothing of the reports built on them."""
