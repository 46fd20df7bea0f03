"""Batch pipelines: functions from source frames to dimension and fact frames."""
