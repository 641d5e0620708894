"""Named reports, models and batch jobs."""
