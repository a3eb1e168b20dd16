"""Previews of the served tables."""

from tallycard import schemas


def preview(df, key, rows=20):
    """The first rows by key. Each task keeps `rows` candidates only."""
    return df.orderBy(key).limit(rows)


def preview_all(tables, rows=20):
    return {name: preview(df, schemas.PRIMARY_KEYS[name], rows) for name, df in tables.items()}
