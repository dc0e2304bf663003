"""DataFrame -> DataFrame operators. Each takes and returns lazy plans; none collects rows."""
