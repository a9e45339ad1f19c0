"""Relational, quality, dimension, fact, log, version, layout and lineage operators."""
