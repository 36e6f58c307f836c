"""Table schemas, reading and writing, and the mapping of the test tables."""
