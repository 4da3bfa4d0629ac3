"""clinflow: hospital encounter-flow analytics as plain Spark DataFrame functions."""
