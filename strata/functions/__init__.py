from .records import data_type_of, decode, evaluate_once, is_json_object
from .time import (as_wall_clock, day_of, iso_string, on_date, on_dates, parse_day,
                   raw_time, row_time)

__all__ = ["data_type_of", "decode", "evaluate_once", "is_json_object", "as_wall_clock", "day_of", "iso_string",
           "on_date", "on_dates", "parse_day", "raw_time", "row_time"]
