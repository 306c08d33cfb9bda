"""A Spark-native engine that turns large text collections into curated, deduplicated datasets."""
