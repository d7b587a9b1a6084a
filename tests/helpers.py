"""Helpers shared by the test modules (not in conftest: every folder may
have one of that name)."""


def rows(df, *cols):
    """Collect small test results as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))
