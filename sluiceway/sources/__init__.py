"""File sources and sinks, and the tables they feed."""
