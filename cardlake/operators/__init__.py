"""DataFrame operators: joins, deduplication, keys, quantiles, dictionary replacement, rules."""
