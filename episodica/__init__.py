"""Spark-native analytics for episodic frame data."""
