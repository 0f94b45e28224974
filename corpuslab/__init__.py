"""corpuslab: studies of labelled document collections as Spark jobs."""

__version__ = "0.1.0"
