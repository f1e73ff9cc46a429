"""What the tests of the training-data operators share."""

LONG = "lorem ipsum dolor sit amet " * 40_000


def plain(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
