"""Bronze, silver and gold tables composed from the operators."""
