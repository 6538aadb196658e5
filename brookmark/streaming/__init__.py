"""Change-log parsing and the continuously maintained mirror."""
