"""The analyses: warehouse build, reporting views, variance, customers, forecast."""
