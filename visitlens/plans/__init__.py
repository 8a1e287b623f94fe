"""Complete jobs.  Each function takes (spark, sf_dir) and returns a
DataFrame; ``catalog.queries()`` lists them by name."""
