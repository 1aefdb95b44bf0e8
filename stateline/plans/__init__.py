"""The cleaning plans, the state model and the reports on it."""
