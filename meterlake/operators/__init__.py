"""DataFrame → DataFrame operators: curation, quality, grains, regression, anomalies."""
