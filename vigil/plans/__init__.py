"""Plans: compositions of operators (training, scoring and monitoring runs) and the query registry."""
