from .expr import epoch_micros, epoch_seconds, nvl_zero, percent, round_div, seconds_between

__all__ = ["epoch_micros", "epoch_seconds", "nvl_zero", "percent", "round_div", "seconds_between"]
