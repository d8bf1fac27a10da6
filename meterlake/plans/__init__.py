"""Query plans over the curated table: business queries, predictions, insights, dashboard feeds."""
