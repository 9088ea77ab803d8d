"""Column factories: row-level expressions, window specs and aggregate metrics."""
