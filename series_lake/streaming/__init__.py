"""The same work on files as they arrive, each call handling what is new."""
