"""Where rows come from and where they go: CSV, message logs, tables, catalog."""
