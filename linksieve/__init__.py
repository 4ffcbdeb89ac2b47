"""URL-corpus analytics and classification on Spark."""
