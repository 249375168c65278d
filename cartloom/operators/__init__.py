"""DataFrame -> DataFrame operators: flatten, conform, merge, slicing, quality."""
