"""Default parameters. Every operator takes its own arguments; these are the defaults."""

# They decide results, so they are stated plainly here.

# Electric readings: centre and spread of voltage and current, and of their product.
VOLTAGE_MEAN = 230.0
VOLTAGE_STD = 5.0
CURRENT_MEAN = 10.0
CURRENT_STD = 2.0

# Machine readings: shift and scale of the five features, in this order.
MACHINE_FEATURES = ("vibration_x", "vibration_y", "vibration_z", "temperature", "pressure")
MACHINE_SHIFT = (0.5, 0.5, 0.5, 65.0, 100.0)
MACHINE_SCALE = (1.0, 1.0, 1.0, 20.0, 30.0)

# Cut-offs that tell the kinds of anomaly apart, midway between the factors
# 1.3 / 0.7 (voltage), 2.0 (current) and 1.2 with 1.5 (surge) and normal operation.
OVERVOLTAGE = 287.5
UNDERVOLTAGE = 172.5
OVERCURRENT = 17.5
SURGE_VOLTAGE = 264.5
SURGE_CURRENT = 14.0

# Entities known to the electric network.
EDGE_REGIONS = {
    "village_1": "north",
    "village_2": "north",
    "village_3": "south",
    "village_4": "south",
}
UNKNOWN_REGION = "unknown"

# Windows and rounds.
WINDOW = "30 seconds"
WATERMARK = "10 seconds"
REGIONS_PER_ROUND = 2
ROUND_TIMEOUT_SECONDS = 60
ROUND_DELAY_SECONDS = 10
NODES_PER_ROUND = 1
ROUND_INTERVAL = "30 seconds"
PUBLISH_INTERVAL_MS = 10_000
TRAIN_INTERVAL = "5 seconds"

# Training.
TRAIN_EVERY = 50
TRAIN_MINIMUM = 20
BUFFER_ROWS = 1000
MINI_BATCH = 32
LEARNING_RATE = 0.01
L2_ALPHA = 0.0001
SIGMOID_CLIP = 500.0
LOSS_EPSILON = 1e-15

# Decisions.
DETECTION_THRESHOLD = 0.5
ALERT_RATE = 0.15

# Monitoring.
HISTORY_ROWS = 100
SHOWN_ROUNDS = 20
TAIL_LOSSES = 10

# Topic names of the two networks.
TOPICS = {
    "sensor_data": "sensor_data",
    "edge_weights": "edge_weights",
    "fog_agg": "fog_agg",
    "global_model": "global_model",
    "global_metrics": "global_metrics",
    "alerts": "alerts",
}
MACHINE_TOPICS = {1: "sensor-data-node-1", 2: "sensor-data-node-2"}
MACHINE_WEIGHTS_TOPIC = "model-weights"
MACHINE_MODEL_TOPIC = "global-model"
MACHINE_MODEL_KEY = "global_model"

# Scale bounds: what one task, one list or one broadcast may hold.
GROUP_ROWS = 4_000_000
LIST_ROWS = 10_000
SNAPSHOT_EVERY = 16
BROADCAST_BYTES = 64 * 1024 * 1024
