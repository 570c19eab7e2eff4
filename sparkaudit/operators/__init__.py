"""DataFrame operators, one module per stage of an analysis."""
