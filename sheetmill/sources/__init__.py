"""Readers and writers at the edge: PDF folders, CSV and JSON files, recognisers."""
