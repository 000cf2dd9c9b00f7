"""Reading and writing of tables, pages and synthetic buyers."""
