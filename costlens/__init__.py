"""A PySpark-native engine for cloud cost-and-usage analytics."""
