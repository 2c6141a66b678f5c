"""Operators on hash sets, vectors, similarity edges and dictionaries."""
