"""Reports and the jobs that run over the stored tables."""
