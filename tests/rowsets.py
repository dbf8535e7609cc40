"""Helpers the test modules share."""


def rows(df):
    """Order-free contents of a DataFrame."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
