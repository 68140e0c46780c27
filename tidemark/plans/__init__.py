"""Plans: mappings, models, check suites and the jobs composed of them."""
