"""Where rows come from: trip and zone files, JDBC tables, the supplied sample tables."""
