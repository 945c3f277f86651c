"""Column functions; all but exact tokens are built-in JVM expressions."""
