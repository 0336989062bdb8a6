"""storespark: stock-movement analytics for retail stores on PySpark DataFrames."""

from storespark.tables import Tables

__all__ = ["Tables"]
