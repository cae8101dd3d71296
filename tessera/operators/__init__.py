"""DataFrame -> DataFrame operators. Column names are parameters; results are
lazy; nothing is collected."""
