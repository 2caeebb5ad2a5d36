"""Layer tables and the serving store."""
