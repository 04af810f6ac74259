"""Plans: report compositions with their sinks, and the registered query catalogue."""
