"""Whole plans made of operators, and the catalogue of queries."""
