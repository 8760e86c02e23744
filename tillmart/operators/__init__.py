"""DataFrame operators: cleansing, inference, lookups, numbering, quality."""
