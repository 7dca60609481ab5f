"""DataFrame operators: projection, filters, combining tables, measures."""
