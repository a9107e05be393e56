"""Plans: the end-to-end batch run, its sinks, and the query catalogue."""
