"""Order-based splits, ranking metrics, the risk ensemble, the anomaly forest, feature importance."""
