"""Incident analytics as plain functions from DataFrame to DataFrame."""

from blotter.roles import ROLES, VIOLENT_10, VIOLENT_14, Era, Roles

__all__ = ["ROLES", "VIOLENT_10", "VIOLENT_14", "Era", "Roles"]
