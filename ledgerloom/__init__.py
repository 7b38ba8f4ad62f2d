"""A PySpark-native engine for market prices, company profiles and news."""
