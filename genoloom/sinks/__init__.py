"""Writers: rows become lines in a DataFrame, ordered, and are written as text."""
