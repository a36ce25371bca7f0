"""Operators for building training corpora on Spark (see the README's table)."""
