"""DataFrame-to-DataFrame operators: no reads, no writes, no actions."""
