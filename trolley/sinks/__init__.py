"""Writers: landing directory, processed directory, serving table, JDBC, result marts."""
