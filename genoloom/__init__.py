"""Genome-interval, gene-model and evidence analytics as PySpark DataFrame transformations."""
