"""Running the transforms as streaming queries: sinks, triggers, end of input."""
