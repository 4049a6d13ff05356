"""Curation of clinical recordings and their text on Spark."""
