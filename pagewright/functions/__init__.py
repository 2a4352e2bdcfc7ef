"""Column expressions: no Python runs on the executors in this folder."""
