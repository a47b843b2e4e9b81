"""tabsift: audit, clean, mine, model and leak-check tabular data as Spark jobs."""

__version__ = "0.1.0"
