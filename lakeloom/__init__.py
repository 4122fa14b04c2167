"""lakeloom: a Spark-native lake of versioned text records."""
