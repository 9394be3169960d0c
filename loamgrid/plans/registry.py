"""Which function makes which product: the registry the build is assembled from.

An algorithm id names, for products with and without depth, one function from the
shared intermediate tables to a frame keyed by map unit (and interval), and the
products it declares.  Everything is checked when this module is imported: an
included product whose id has no function, a function that doesn't declare it, a
product declared twice or unknown to the model is an error, not a missing column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..model.intervals import DEPTH
from ..model.variables import ALGORITHMS, RegistryError, Variable, included
from ..operators import components as comp
from ..operators import crops, texture
from ..operators.properties import LINEAR_MEASURES, PARTICLE_SIZE
from . import derived


class Context:
    """The tables, and what several algorithms share, made once when first asked for."""

    def __init__(
        self, tables: derived.Tables, *, sums: DataFrame | None = None, summary: DataFrame | None = None, dictionary: DataFrame | None = None,
    ) -> None:
        self.tables = tables
        self._sums, self._summary, self._dictionary = sums, summary, dictionary

    @cached_property
    def soil(self) -> DataFrame:
        return derived.soil_properties(self.tables, self._sums)

    @cached_property
    def summary(self) -> DataFrame:
        return derived.valu1(self.tables, self._sums) if self._summary is None else self._summary

    @cached_property
    def terrain(self) -> DataFrame:
        return comp.terrain(self.tables["component"])

    @cached_property
    def texture(self) -> DataFrame:
        codes = texture.texture_dictionary(self.tables["chtexturegrp"]) if self._dictionary is None else self._dictionary
        surface = texture.surface_texture(self.tables["component"], self.tables["chorizon"], self.tables["chtexturegrp"])
        return texture.encode_texture(surface, codes)


@dataclass(frozen=True)
class Algorithm:
    id: str
    by_depth: bool
    products: tuple[str, ...]
    make: Callable[[Context], DataFrame]


Functions = Mapping[tuple[str, bool], Algorithm]
FUNCTIONS: dict[tuple[str, bool], Algorithm] = {}


def algorithm(id: str, products: Iterable[str], *, by_depth: bool = False, into: dict | None = None) -> Callable:
    """Bind an id to the function below and to the products it makes."""

    def bind(make: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        known = FUNCTIONS if into is None else into
        if id not in ALGORITHMS:
            raise RegistryError(f"unknown algorithm {id!r}")
        if (id, by_depth) in known:
            raise RegistryError(f"algorithm {id!r} is bound twice")
        known[id, by_depth] = Algorithm(id, by_depth, tuple(products), make)
        return make

    return bind


STOCKS = {"valu1_aws": "aws", "valu1_soc": "soc"}
for _id, _stock in STOCKS.items():
    algorithm(_id, (_stock, f"{_stock}_contributing_thickness"), by_depth=True)(lambda c: c.soil)
    algorithm(_id, (f"musumcpct{_stock[0]}",))(lambda c: c.summary)


@algorithm("linear_overlap_component_weighted_mean", [m.name for m in LINEAR_MEASURES], by_depth=True)
@algorithm("composition_shared_mask_weighted_mean", [
    "sand", "silt", "clay", "particle_size_contributing_thickness", "particle_size_contributing_component_percent"], by_depth=True)
@algorithm("dominant_component_least_transmissive", ["ksat"], by_depth=True)
def _soil(c: Context) -> DataFrame:
    return c.soil


@algorithm("valu1_nccpi", crops.RATINGS)
@algorithm("valu1_pctearthmc", ["pctearthmc"])
@algorithm("valu1_rootzone", ["rootznemc", "rootznaws"])
@algorithm("valu1_droughty", ["droughty"])
@algorithm("valu1_pwsl", ["pwsl1pomu"])
@algorithm("valu1_musumcpct", ["musumcpct"])
def _summary(c: Context) -> DataFrame:
    return c.summary


@algorithm("dominant_component", ["slope", "slope_length", "elevation", "aspect"])
def _terrain(c: Context) -> DataFrame:
    return c.terrain


@algorithm("dominant_component_surface_texture", ["texture_class"])
def _texture(c: Context) -> DataFrame:
    return c.texture


def check(variables: Iterable[Variable], functions: Functions) -> None:
    """Every included product has one function that declares it, and nothing else is declared."""
    wanted = {v.name: v for v in variables if not v.is_key}
    makers: dict[str, Algorithm] = {}
    for a in functions.values():
        for name in a.products:
            if name in makers:
                raise RegistryError(f"{name}: made by both {makers[name].id!r} and {a.id!r}")
            makers[name] = a
    for v in wanted.values():
        a = functions.get((v.algorithm, v.by_depth))
        if a is None:
            raise RegistryError(f"{v.name}: algorithm {v.algorithm!r} has no function")
        if v.name not in a.products:
            raise RegistryError(f"{v.name}: not declared by the function of {v.algorithm!r}")
    loose = sorted(set(makers) - set(wanted))
    if loose:
        raise RegistryError(f"declared but not registered as products: {loose}")


def assemble(c: Context, by_depth: bool, variables: Iterable[Variable] | None = None, functions: Functions = FUNCTIONS) -> DataFrame:
    """All products with, or all without depth, side by side; keys known to any of their frames are kept.

    Products whose functions return the same frame are columns of it, so a shared
    intermediate table is joined once however many products come from it.
    """
    chosen = [v for v in (included() if variables is None else variables) if not v.is_key]
    check(chosen, functions)
    keys = ["mukey", DEPTH] if by_depth else ["mukey"]
    frames: list[tuple[DataFrame, list[str]]] = []
    for v in chosen:
        if v.by_depth == by_depth:
            frame = functions[v.algorithm, by_depth].make(c)
            names = next((n for f, n in frames if f is frame), None)
            if names is None:
                frames.append((frame, names := []))
            names.append(v.name)
    out = None
    for frame, names in frames:
        part = frame.select(*keys, *names)
        out = part if out is None else out.join(part, keys, "full")
    return out


check(included(), FUNCTIONS)
