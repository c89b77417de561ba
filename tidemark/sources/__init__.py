"""Where rows come from: message log, files, relational tables, catalog metadata."""
