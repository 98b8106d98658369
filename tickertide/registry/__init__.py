"""Named queries over the provided tables, each with its check in SQL."""
