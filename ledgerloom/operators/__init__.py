"""DataFrame-to-DataFrame operators used by the load jobs and reports."""
