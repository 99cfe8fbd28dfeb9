"""rttlab: Spark-native analytics for internet latency measurements."""
