"""Composites: silver (J3), gold (J4), build (J5), train (J6), stage comparison (J7), and the
registered driver queries."""
