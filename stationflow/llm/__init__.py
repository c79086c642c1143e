"""Training-data operators: one module per operator, shared helpers, and the registered queries in ``queries``."""
