"""pairscope: user-route pair features, labels, sampling, model and publishing on Spark."""
