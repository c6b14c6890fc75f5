"""Record extraction, resolution and reconciliation as Spark jobs."""
