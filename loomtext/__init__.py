"""Spark-native extraction of clean, tokenised text from encyclopedia dumps and raw web markup."""
