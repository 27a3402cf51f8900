"""Plans: whole-contract pipelines (P) and set-based catalog jobs (L5, R, K)."""
