"""Training-data operators: one module per operator, each with its own general
interface, and ``queries.py`` with the thin registered queries."""
