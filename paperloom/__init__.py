"""Spark jobs for building and analysing a linked database of scholarly papers."""
