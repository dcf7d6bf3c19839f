"""Plans: whole pipelines from landed tables to events, and the reports over events."""
