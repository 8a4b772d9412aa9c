"""Run parameters shared by every pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Pipeline parameters.

    start_year           first school year kept by the staging views
    current_school_year  release label such as '2023-2024'; its first four
                         characters select the slice of an incremental run
    numeric_scale        decimals kept when dirty text is cleaned to a number
    """

    start_year: int = 2019
    current_school_year: str = "2023-2024"
    numeric_scale: int = 0

    @property
    def current_year(self) -> int:
        return int(self.current_school_year[:4])


# Parameters that fit the driver test tables (ship years 1995-2001).
TEST_PARAMS = Params(start_year=1997, current_school_year="2000-2001")
