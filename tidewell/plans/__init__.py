"""Plans that put the operators together for one table."""
