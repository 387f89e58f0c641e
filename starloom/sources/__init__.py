from .files import read_orders, read_people, read_returns, read_listings, read_reviews
from .testdata import TestData

__all__ = ["read_orders", "read_people", "read_returns", "read_listings", "read_reviews", "TestData"]
