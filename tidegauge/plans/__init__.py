"""The named queries over the tables, and the same in SQL."""
