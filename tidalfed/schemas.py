"""Declared message schemas (fixed values: field names and types of the wire format)."""

READING_ELECTRIC = (
    "edge_id string, timestamp string, voltage double, current double, power double, "
    "label int, type string"
)

READING_MACHINE = (
    "timestamp string, node_id int, sensor_id string, "
    "features struct<vibration_x: double, vibration_y: double, vibration_z: double, "
    "temperature: double, pressure: double>, label int"
)

LINEAR_WEIGHTS = "struct<coef: array<array<double>>, intercept: array<double>, classes: array<int>>"

EDGE_UPDATE = (
    "edge_id string, region string, round int, timestamp string, n_samples int, "
    f"weights {LINEAR_WEIGHTS}, "
    "metrics struct<local_accuracy: double, total_samples: int, anomalies_detected: int>"
)

REGION_AGGREGATE = (
    "region string, window_start timestamp, window_end timestamp, "
    f"contributing_edges array<string>, all_weights array<{LINEAR_WEIGHTS}>, "
    "total_n_samples bigint, avg_accuracy double, total_anomalies bigint, "
    "fog_timestamp timestamp"
)

GLOBAL_MODEL_ELECTRIC = (
    f"round int, timestamp string, global_weights {LINEAR_WEIGHTS}, "
    "participating_regions array<string>, total_samples bigint"
)

GLOBAL_METRICS = (
    "round int, timestamp string, total_samples bigint, participating_regions array<string>, "
    "num_updates bigint, anomalies_detected bigint"
)

NODE_UPDATE = (
    "node_id int, timestamp string, "
    "model_weights struct<weights: array<double>, bias: double, num_samples: bigint>, loss double"
)

GLOBAL_MODEL_MACHINE = (
    "round int, aggregated_weights struct<weights: array<double>, bias: double>, "
    "loss_history array<double>, timestamp string, participating_nodes array<int>, "
    "aggregation_info struct<weights: array<double>, bias: double, total_samples: bigint, "
    "weighted_loss: double>"
)

ROUND_LOG = (
    "round int, timestamp string, weighted_loss double, total_samples bigint, "
    "participating_nodes array<string>, weights_norm double, page int"
)

ALERT = (
    "edge_id string, window_start timestamp, window_end timestamp, anomaly_rate double, "
    "severity string"
)
