"""Column functions: nothing here reads data or shuffles."""
