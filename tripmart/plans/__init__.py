"""Whole flows: the layer builds and the answers as SQL."""
