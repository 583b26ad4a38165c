"""The reports a shop asks for, each a function from its input tables to the result."""
