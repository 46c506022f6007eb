"""Helpers of the tests."""


def values(frame, *columns):
    """Rows as sorted tuples; of one column as a sorted list."""
    rows = [tuple(r) for r in frame.select(*columns or frame.columns).collect()]
    rows.sort(key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))
    return [r[0] for r in rows] if rows and len(rows[0]) == 1 else rows
