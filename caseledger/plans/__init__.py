"""Rules and projections compiled to Column expressions before a plan is built."""
