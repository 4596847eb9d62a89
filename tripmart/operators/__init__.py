"""DataFrame-to-DataFrame transformations."""
