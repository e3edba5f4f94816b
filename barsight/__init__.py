"""barsight: price-bar feature engineering, signal ranking and feature-table
maintenance expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
