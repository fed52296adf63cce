"""DataFrame -> DataFrame operators.  Each one is a composition of built-in
Spark operators; none collects data to the driver."""
