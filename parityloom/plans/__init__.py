"""What is built of the operators: population, reports, gates, and the catalogue of queries."""
