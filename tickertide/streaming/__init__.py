"""The same work as Structured Streaming queries."""
