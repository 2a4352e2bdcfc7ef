"""Where blocks, catalogs and responses come from, and where results go."""
