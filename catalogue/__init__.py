"""The registered queries: fixtures, Spark side and SQL side."""
