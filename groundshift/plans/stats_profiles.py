"""Threshold profiles of a decline: least before, most after, greatest change."""

PROFILES = {"default": (0.4, 0.35, -0.1), "conservative": (0.45, 0.3, -0.2), "relaxed": (0.35, 0.4, -0.05)}
