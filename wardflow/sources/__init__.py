"""Table and stream reads and writes."""
