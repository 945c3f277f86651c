"""The lookup and the load on unbounded input."""
