"""Narrative analytics as Spark jobs: cleaning, tokens, entities, sentiment, features, marts."""

__version__ = "0.1.0"
