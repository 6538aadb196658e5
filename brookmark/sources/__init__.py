"""Reading and writing: extracts, the dated landing area, stored tables, change logs."""
