"""millrace: a Spark-native engine for sensor time series and corpus preparation."""
