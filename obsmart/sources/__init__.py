"""Readers: raw payloads, landed responses, the place dimension, day-partitioned layers."""
