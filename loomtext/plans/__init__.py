"""Whole plans: dump extraction, rendered inputs and the checked queries."""
