"""End-to-end load jobs and reports, composed of the operators and column functions."""
