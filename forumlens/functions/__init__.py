"""Column-level building blocks: text, numbers, literal lookups."""
