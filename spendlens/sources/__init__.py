"""Reading archives, the table catalog, type inference and writing results."""
