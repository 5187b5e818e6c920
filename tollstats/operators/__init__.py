"""DataFrame-to-DataFrame operators composed of Spark built-ins."""
