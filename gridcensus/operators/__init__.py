"""DataFrame operators: joins, aggregates, spatial jobs, gates, checks, profiles."""
