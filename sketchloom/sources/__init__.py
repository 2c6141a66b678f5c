"""Readers and writers of sketch files, vectors, id lists and matrices."""
