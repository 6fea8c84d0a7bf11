"""Web-page snapshot tables to clean entity tables, as Spark jobs."""
