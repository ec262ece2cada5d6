"""DataFrame -> DataFrame operators, one module per domain."""
