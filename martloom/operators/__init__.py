"""DataFrame operators the models are built from."""
