"""Rows of a frame in a form that compares."""


def rows(df, *cols):
    """Rows as a sorted list of tuples; NULL sorts as text."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
