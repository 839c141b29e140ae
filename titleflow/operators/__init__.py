"""DataFrame -> DataFrame operators: joins, text, sampling, metrics,
images, models, tuning."""
