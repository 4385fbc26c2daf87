"""The query catalogue and the batch run that materialises every table."""
