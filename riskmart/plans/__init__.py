"""Table-to-table plans: silver, gold, quality, training, scoring, monitoring, governance."""
