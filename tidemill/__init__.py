"""tidemill: a Spark-native engine for data that is gathered page by page."""
