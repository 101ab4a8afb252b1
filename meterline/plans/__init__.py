"""Whole stages and queries, composed from operators."""
