from citystream.functions.geo import haversine_m
from citystream.functions.time import event_time, epoch_ms, iso_string, bound_string

__all__ = ["haversine_m", "event_time", "epoch_ms", "iso_string", "bound_string"]
