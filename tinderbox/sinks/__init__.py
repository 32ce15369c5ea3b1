"""Writers: range replacement, append, swap, upsert and exports."""
