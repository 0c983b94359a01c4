"""The jobs, and the queries that show every operator on the test tables."""
