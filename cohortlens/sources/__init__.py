"""Input schemas, readers, the sink and bindings of the test tables."""
