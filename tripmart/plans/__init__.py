"""The domain: staging dimensions, cleaned facts, marts, dashboard questions and quality checks."""
