"""End-to-end plans over the operators, and the series that reports read from them."""
