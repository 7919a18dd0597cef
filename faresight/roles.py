"""Column roles. Operators take names from here instead of hard-coding them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    target: str
    date: str
    leaky: tuple[str, ...] = ()
    redundant: tuple[str, ...] = ()
    cat: tuple[str, ...] = ()
    num: tuple[str, ...] = ()
    freq: tuple[str, ...] = ()
    prediction: str = "prediction"
    # names of the columns the feature builder reads
    source: str = "source"
    destination: str = "destination"
    airline: str = "airline"
    travel_class: str = "travel_class"
    stopovers: str = "stopovers"
    duration: str = "duration_hrs"
    days_before: str = "days_before"
    extra: dict = field(default_factory=dict)

    @property
    def drop_for_model(self) -> tuple[str, ...]:
        return (self.target,) + self.leaky + self.redundant + (self.date,)


# Column roles of the flight-shaped view (faresight.sources.flights).
FLIGHT_ROLES = Roles(
    target="total_fare",
    date="departure",
    leaky=("base_fare", "tax"),
    redundant=("source_name", "destination_name", "arrival"),
    cat=("airline", "source", "destination", "travel_class", "stopovers",
         "aircraft_type", "booking_source", "seasonality"),
    num=("duration_hrs", "days_before"),
    freq=("route", "airline", "airline_class", "destination"),
)

# Categorical columns after feature engineering, in model order.
ENGINEERED_CAT = ("airline", "source", "destination", "travel_class", "stopovers", "aircraft_type",
                  "booking_source", "seasonality", "route", "airline_class", "booking_window", "haul_type")
