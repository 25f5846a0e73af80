"""End-to-end flows: prepare, cross-validate, train, score."""
