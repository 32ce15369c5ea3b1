"""Column expressions; none of them needs a session or a Python worker unless it says so."""
