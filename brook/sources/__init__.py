"""Text lines, topic messages, paced replay, tracked feed."""
