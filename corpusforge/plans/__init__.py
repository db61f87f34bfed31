"""Operators bound to tables: the registered queries and the corpus refresh job."""
