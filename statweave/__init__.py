"""Spark-native operators for revisioned event feeds, yearly snapshots and weighted samples."""
