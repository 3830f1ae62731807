"""Plans: gold SQL models, report queries, metadata tables, batch jobs and the
named query registry."""
