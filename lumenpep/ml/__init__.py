"""The workflow of models: registry, validation, prediction, statistics of features."""
