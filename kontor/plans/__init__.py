"""Reports composed from the operators, in DataFrame and SQL form."""
