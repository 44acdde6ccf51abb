"""The streaming jobs: topic to topic, topic to landing table, landing table to star."""
