"""Relational operators: grouping of words, ranking, consensus and classification."""
