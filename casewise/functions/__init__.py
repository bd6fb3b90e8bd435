"""Column-expression builders (no Python UDFs): columns, features, formatting."""
