"""The registered queries, the tables they run on, and the SQL they are compared with."""
