from silverlode.plans.pipeline import build_silver, ingest, run_pipeline, silver_tables

__all__ = ["build_silver", "ingest", "run_pipeline", "silver_tables"]
