"""Complete analyses; each returns a lazy DataFrame."""
