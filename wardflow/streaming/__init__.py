"""The ingest stream and the upkeep of the tables it writes."""
