"""Reading tables and running parameterised queries."""
