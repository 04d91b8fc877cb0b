"""Column -> Column cleaners.  All are native expressions; none is a Python UDF."""
