"""Column functions: parsing, sampling, texts, and columns computed once per row."""
