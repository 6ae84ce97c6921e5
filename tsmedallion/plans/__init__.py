"""The daily run, and the queries that show every operator on given tables."""
