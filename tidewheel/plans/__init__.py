"""End-to-end flows: raw files to star schema, star schema to models, requests to forecasts."""
