"""Driving-behaviour analytics over vehicle telemetry, written for Spark."""

__version__ = "0.1.0"
