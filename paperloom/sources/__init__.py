"""Reading releases, writing tables and exports."""
