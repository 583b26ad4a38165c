"""Where rows come from: JSON records, topics, change capture, databases, cell tables, dated partitions, the rate feed."""
