"""A PySpark-native engine for versioned, audited report tables."""
