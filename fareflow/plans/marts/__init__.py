"""Tables for reading: alerts, booking windows, routes, carriers, sample."""
