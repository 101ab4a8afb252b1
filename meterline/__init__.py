"""Trip analytics on Spark DataFrames: landing, cleaning, features, quality, marts, entities."""

__version__ = "0.1.0"
