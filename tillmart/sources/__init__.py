"""Tables: the raw zone, day-partitioned staging and marts, shared scratch space."""
