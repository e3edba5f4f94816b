from barsight.sources.prices import read_table  # noqa: F401
