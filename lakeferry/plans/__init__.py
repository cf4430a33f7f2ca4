"""Where data lives while a job runs, and how a finished result becomes visible."""
