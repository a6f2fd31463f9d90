"""The registered queries over the benchmark tables, with equivalent SQL for checking."""
