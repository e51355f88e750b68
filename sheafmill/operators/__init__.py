"""Relational operators over elements, chunks, tables and page geometry."""
