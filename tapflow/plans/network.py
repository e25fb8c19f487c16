"""The stop dictionaries of a run, sized once and shared by all steps."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tapflow.operators.alighting import nearby_stops
from tapflow.operators.sites import all_sites, near_sites
from tapflow.operators.sizing import broadcast_if_small, cut_lineage, is_small


@dataclass
class Network:
    """Stops of the city; `saved_near` is a near-stop table built earlier.

    Dictionaries are read once and carry a broadcast hint where a count allowed it.
    """

    bus_dictionary: DataFrame
    rail_dictionary: DataFrame | None = None
    saved_near: DataFrame | None = None

    @cached_property
    def bus_sites(self) -> DataFrame:
        return broadcast_if_small(self.bus_dictionary.persist())

    @cached_property
    def rail_sites(self) -> DataFrame | None:
        if self.rail_dictionary is None:
            return None
        return broadcast_if_small(self.rail_dictionary.persist())

    @cached_property
    def near(self) -> DataFrame:
        if self.saved_near is not None:
            return self.saved_near
        bus = self.bus_sites
        return near_sites(bus if self.rail_sites is None else all_sites(bus, self.rail_sites), bus)

    def nearby(self, routes: DataFrame) -> DataFrame:
        """The near-stop table as the alighting step looks it up, for riders of these `routes` (one column, repeats allowed).

        The step looks up pairs of a boarded route and a target route. Riders board buses of `routes` only, and go on from
        there to one of these or to a rail line, which may share its number with a bus route: no other stops are searched.
        """
        rides = cut_lineage(routes.select("route").distinct())
        targets = rides if self.rail_sites is None else rides.unionByName(self.rail_sites.select("route")).distinct()
        rides, targets = broadcast_if_small(rides), broadcast_if_small(targets)
        if self.saved_near is not None:
            near = self.saved_near.join(targets, "route", "left_semi").join(
                rides.withColumnRenamed("route", "route2"), "route2", "left_semi"
            )
        else:
            # Small tables now, whose rows are read several times.
            to = cut_lineage(self.bus_sites.join(targets, "route", "left_semi"))
            near = near_sites(
                to if self.rail_sites is None else all_sites(to, self.rail_sites), to.join(rides, "route", "left_semi")
            )
        stops = cut_lineage(nearby_stops(near))
        return stops.hint("broadcast") if is_small(stops.selectExpr("explode(stops)")) else stops
