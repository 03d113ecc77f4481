"""Bicycle-sharing analytics on Spark DataFrames.

Every function takes DataFrames with the canonical columns of
``docklens.schemas`` and returns a DataFrame; nothing runs before the caller
asks for an action, except model fitting and writing.
"""

from docklens.api import BikeShare
from docklens.config import BORDEAUX, CITIES, LYON, CityConfig, time_window

__all__ = ["BORDEAUX", "BikeShare", "CITIES", "CityConfig", "LYON", "time_window"]
