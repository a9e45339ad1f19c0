"""Operators of a training-data pipeline over text. Nothing else in the library imports this folder."""
