"""Dashboard queries, jobs and the mapping of the retail tables onto order items."""
