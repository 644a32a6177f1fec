"""farebox: trip-record cleaning, loading and analytics as Spark jobs."""
