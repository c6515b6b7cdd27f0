"""The engine's operators run on the driver's tables, with equivalent SQL."""
