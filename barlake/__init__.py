"""barlake: a Spark-native lakehouse and feature engine for intraday price bars."""
