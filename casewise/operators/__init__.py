"""DataFrame operators: profiling, statistics, sampling, features, models, metrics."""
