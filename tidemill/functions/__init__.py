"""Column functions: each maps columns to a column and never shuffles."""
