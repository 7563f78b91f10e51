"""Jobs: operators chained from a source to a sink."""
