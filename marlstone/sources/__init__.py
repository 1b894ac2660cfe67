"""Readers, the file manifest, the bronze unifier and the sinks."""
