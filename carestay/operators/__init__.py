"""DataFrame → DataFrame operators of the stay analytics."""
