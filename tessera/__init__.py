"""A Spark-native analytics engine over declared resources."""
