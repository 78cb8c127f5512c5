"""Query plans: models, marts, reports, the daily job and the pipeline."""
