"""Fixture-bound query plans: the operators of ``tidewater.operators`` applied to the driver tables."""
