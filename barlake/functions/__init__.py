"""Column helpers shared by the operators (no actions, no joins)."""
