"""PySpark-native analytics for scholarly records and documents."""

__version__ = "0.1.0"
