"""Column builders shared by the queries."""
