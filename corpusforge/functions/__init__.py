"""Column -> Column building blocks; nothing here starts a job."""
