"""The same loads, fed by files as they arrive."""
