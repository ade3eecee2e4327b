"""DataFrame operators: cleaning, deduplication, business tables, reports and checks."""
