"""From cleaned feeds to legs, transfers and journeys, for one day or many at once.

Everything is keyed by service_date, so a month is one job over a month of rows: there is no loop
over days.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tapflow.operators import alighting, boarding, chain, gps, legs, rail
from tapflow.operators.journeys import HEAD_AND_LAST, journeys
from tapflow.operators.ordered import HOT_ROWS, hot_keys
from tapflow.operators.sizing import cut_lineage, is_small
from tapflow.operators.transfers import transfer_labels, transfer_pairs
from tapflow.plans.network import Network
from tapflow.schemas import PERSON_DAY

BUS, BUS_RAIL = "bus", "bus_rail"


@dataclass
class OdPlan:
    """The steps of a run as lazily built frames; each one is public.

    `earlier_history` adds saved weights (with the columns of `weights`) to the run's own. `feeds_stored` says that taps
    and gates are tables already, with their times as numbers.
    """

    taps: DataFrame
    gps_fixes: DataFrame
    network: Network
    gates: DataFrame | None = None
    earlier_history: DataFrame | None = None
    keep_unmatched: bool = False
    fare: str = HEAD_AND_LAST
    hot_rows: int = HOT_ROWS
    feeds_stored: bool = False

    @cached_property
    def stored_taps(self) -> DataFrame:
        """The taps written out: several steps start from them, and reading their times out of text is dear."""
        return self.taps if self.feeds_stored else cut_lineage(self.taps)

    @cached_property
    def stored_gates(self) -> DataFrame | None:
        return self.gates if self.gates is None or self.feeds_stored else cut_lineage(self.gates)

    @cached_property
    def hot_persons(self) -> DataFrame | None:
        """Person-days too large for one task; raw records bound every later step's rows."""
        feeds = [self.stored_taps] if self.gates is None else [self.stored_taps, self.stored_gates]
        return hot_keys(feeds, PERSON_DAY, self.hot_rows)

    @cached_property
    def trip_runs(self) -> DataFrame:
        """Written out, because boarding and alighting both need them."""
        return cut_lineage(gps.trip_runs(gps.dwell_first(self.gps_fixes)))

    @cached_property
    def run_fixes(self) -> DataFrame:
        return gps.run_fixes(self.trip_runs)

    @cached_property
    def asof(self) -> DataFrame:
        return boarding.board_asof(self.stored_taps, self.trip_runs)

    @cached_property
    def boarded(self) -> DataFrame:
        return boarding.site_lookup(self.asof, self.network.bus_sites)

    @cached_property
    def rail_legs(self) -> DataFrame | None:
        """Written out, because both the chain and the legs need them."""
        if self.gates is None:
            return None
        located = rail.station_join(self.stored_gates, self.network.rail_sites)
        return cut_lineage(rail.rail_legs(located, self.hot_persons))

    @cached_property
    def chain(self) -> DataFrame:
        boardings = self.boarded
        if self.rail_legs is not None:
            boardings = chain.with_rail_boardings(boardings, self.rail_legs)
        return chain.travel_chain(boardings, self.hot_persons)

    @cached_property
    def inferred(self) -> DataFrame:
        """Written out: the history is counted from it before the boardings left open are settled,
        and losing an executor must not repeat the way from the feeds to here."""
        return cut_lineage(alighting.infer(self.chain, self.run_fixes, self.network.nearby(self.stored_taps)))

    @cached_property
    def settled(self) -> DataFrame:
        return alighting.one_leg_per_tap(self.inferred)

    @cached_property
    def resolved(self) -> DataFrame:
        return alighting.resolved_legs(self.settled)

    @cached_property
    def weights(self) -> DataFrame:
        return alighting.alight_weights(self.resolved)

    @cached_property
    def history(self) -> DataFrame:
        """One row per day, route and stop."""
        if self.earlier_history is None:
            return self.weights
        return alighting.merge_history(self.weights, self.earlier_history)

    @cached_property
    def fallback(self) -> DataFrame:
        history = self.history.persist()
        by_route = alighting.history_by_route(history)
        if is_small(history):
            by_route = by_route.hint("broadcast")
        return alighting.fallback_legs(self.settled, by_route, self.keep_unmatched)

    @cached_property
    def rides(self) -> DataFrame:
        return self.resolved.unionByName(self.fallback)

    def bus_legs(self, how: str = "inner") -> DataFrame:
        return legs.enrich(self.rides, self.network.bus_sites, how)

    @cached_property
    def legs(self) -> DataFrame:
        return legs.all_legs(self.bus_legs(), self.rail_legs)

    @cached_property
    def labelled(self) -> DataFrame:
        return transfer_labels(self.legs, self.hot_persons)

    @cached_property
    def transfers(self) -> DataFrame:
        return transfer_pairs(self.legs, self.hot_persons)

    @cached_property
    def journeys(self) -> DataFrame:
        return journeys(self.legs, self.fare, self.hot_persons)
