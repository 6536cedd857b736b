"""Reading and writing files and tables, and rows from saved pages."""
