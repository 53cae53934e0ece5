"""Column helpers: clock, numbers, text."""
