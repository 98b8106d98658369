"""Stock-mention, signal and sentiment analytics over forum messages, on Spark."""
