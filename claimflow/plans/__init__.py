"""Layer runs and the registered queries."""
