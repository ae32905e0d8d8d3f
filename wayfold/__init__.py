"""wayfold: Spark-native analytics for pedestrian graphs, places and their data quality."""

__version__ = "0.1.0"
