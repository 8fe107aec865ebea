"""Paths and row helpers shared by the tests (a module of its own name, so that no
other folder's conftest can stand in for it)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Collect as sorted tuples (for small hand-made frames)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))
