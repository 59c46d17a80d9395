"""Station, trip, page and question analytics expressed as Spark plans."""

__version__ = "0.1.0"
