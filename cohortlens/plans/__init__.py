"""The models: staging, rollups, profile, scored mart, reports and checks."""
