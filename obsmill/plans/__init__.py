"""Plan documents and task expansion."""
