"""Reading and writing log tables, plain files, catalog tables and batch configurations."""
