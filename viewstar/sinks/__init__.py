"""Where rows go: warehouse folders, a database, a topic."""
