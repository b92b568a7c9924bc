"""The models: staging, intermediate and mart layers."""
