"""Event-time queries over detections; extensions that batch tables share."""
