"""Query plans: the all-methods pipeline and the registered queries."""
