"""The reference's jobs as functions, and the registered queries."""
