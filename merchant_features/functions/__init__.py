"""Column-level building blocks: periods, predicates, scalar expressions, geometry."""
