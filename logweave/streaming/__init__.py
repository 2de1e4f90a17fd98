"""The same operators on streams, with the state and sinks they need."""
