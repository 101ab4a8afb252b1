"""Reading and writing: the trip view, layers, tables, sinks, shared scratch space."""
