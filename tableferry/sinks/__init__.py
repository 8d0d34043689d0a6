"""Publishing tables: partitioned files, databases, batched writers."""
