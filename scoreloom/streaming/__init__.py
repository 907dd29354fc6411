"""The batch operators on files that keep arriving."""
