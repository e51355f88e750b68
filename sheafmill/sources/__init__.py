"""Readers of office files and workbooks into element tables."""
