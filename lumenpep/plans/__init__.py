"""Plans over the operators: candidates ranked under flags, and stage tables that a rerun finds again."""
