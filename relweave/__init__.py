"""A PySpark-native engine that infers, measures and validates relationships between tables."""
