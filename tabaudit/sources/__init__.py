"""Reading and writing tables, reports, fitted state and the run log."""
