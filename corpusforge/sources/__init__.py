"""Reading landed files and catalog tables, and writing results."""
