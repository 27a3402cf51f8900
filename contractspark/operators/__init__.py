"""Operators over data: convert (C), rename/cast (T), rules (E), write (W), tags (G)."""
