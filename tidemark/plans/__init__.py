"""Jobs: read, transform with the operators, write. Each can be run again safely."""
