"""billmill: a utility-billing warehouse built from Spark DataFrame jobs."""
