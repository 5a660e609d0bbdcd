"""A PySpark-native engine for building and curating multi-turn conversation datasets."""
