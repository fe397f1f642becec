"""Jobs composed into a database build."""
