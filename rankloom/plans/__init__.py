"""Named queries: shared inputs, Spark queries and their SQL oracle."""
