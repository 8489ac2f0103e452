"""DataFrame operators: parsing, flattening, folding and data quality."""
