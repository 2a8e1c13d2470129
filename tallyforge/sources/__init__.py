"""Sources, sinks and load-time quality gates."""
