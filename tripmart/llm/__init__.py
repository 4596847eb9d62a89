"""Corpus operators: what a training-data pipeline needs beside the trip tables."""
