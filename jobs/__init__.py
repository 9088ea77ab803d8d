"""Command-line entry points; each one ends in a write (an action)."""
