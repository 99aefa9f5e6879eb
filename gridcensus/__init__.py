"""Small-area weather exposure analytics, expressed as Spark DataFrame jobs."""
