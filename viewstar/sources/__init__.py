"""Where rows come from: topics, the landing table, document stores, the warehouse."""
