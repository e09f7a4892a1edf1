"""Survey responses as a stream."""
