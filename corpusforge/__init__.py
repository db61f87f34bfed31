"""corpusforge: corpus building, search and evaluation as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
