"""tidings: a PySpark-native engine for collecting, cleaning and tracking board-style notices."""
