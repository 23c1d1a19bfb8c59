"""gleaner: a PySpark engine for graded-evidence event data."""
