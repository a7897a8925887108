"""docfleet: document-operations analytics as plain Spark DataFrame functions."""
