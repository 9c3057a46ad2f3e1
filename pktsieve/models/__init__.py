"""The repository's own models: the tree as a table of fixed values, the centres as text."""
