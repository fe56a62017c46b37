"""Column helpers with explicit rules for missing values, text and periods."""
