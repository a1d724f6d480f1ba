"""Stateful segmentation of ping streams (batch and Structured Streaming forms)."""
