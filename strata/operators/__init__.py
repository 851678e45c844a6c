"""DataFrame -> DataFrame operators. None of them does I/O or runs an action."""
