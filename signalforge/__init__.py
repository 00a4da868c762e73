"""A PySpark-native engine for hiring-signal analytics and training-data preparation."""
