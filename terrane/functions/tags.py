"""Free-form tags (map<string,string>) as Column expressions: rules, access, speeds, directions, one-way signs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import let

# What a key's value says of access by car; lists that a road's class is looked up in.
ACCESS_YES = ("yes", "private", "permissive", "use_sidepath", "delivery", "designated", "dismount", "destination", "customers", "official", "public", "restricted", "allowed", "permit", "residents")
ACCESS_NO = ("no", "agricultural", "discouraged", "forestry", "emergency", "psv")
VEHICLE_YES = ("yes", "private", "permissive", "delivery", "designated", "destination", "customers", "official", "public", "restricted", "allowed", "permit", "residents")
VEHICLE_NO = ("no", "agricultural", "discouraged", "forestry")
PRIVATE = ("private", "destination", "customers", "delivery", "permit", "residents")
CAR_ROADS = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "residential_link", "living_street", "service", "track", "road")
FERRIES = ("ferry", "shuttle_train")
COMPASS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW")
MPH = 1.609344


def tag(tags: Column, key: str) -> Column:
    """A key's value, null where it is missing or empty."""
    return F.nullif(F.try_element_at(tags, F.lit(key)), F.lit(""))


def values(value: Column) -> Column:
    """The values of a `;` list, trimmed, without empty ones; empty for null."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ";"), lambda v: F.trim(v)), lambda v: v != "")


def matches(tags: Column, conditions: list[dict[str, list[str]]], absent: bool = True) -> Column:
    """Whether any condition holds as a whole: each key has one of its values, '*' any; with absent, '!key' means it isn't there."""
    def one(condition: dict[str, list[str]]) -> Column:
        out = F.lit(True)
        for key, wanted in condition.items():
            if absent and key.startswith("!"):
                out = out & (F.size(values(F.try_element_at(tags, F.lit(key[1:])))) == 0)
                continue
            got = values(F.try_element_at(tags, F.lit(key)))
            out = out & (F.size(got) > 0 if "*" in wanted else F.exists(got, lambda v: v.isin(list(wanted))))
        return out

    whole = F.lit(False)
    for c in conditions:
        whole = whole | one(c)
    return whole


def first_rule(tags: Column, rules: list[dict], named: Column) -> Column:
    """The name of the first rule that matches; null if that very rule wants a name and there is none."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(F.lit(not rule.get("named", False)) | named, F.lit(rule["kind"]))
        out = F.when(matches(tags, rule["match"]), found).otherwise(out)
    return out


def road_like(tags: Column) -> Column:
    return tag(tags, "highway").isNotNull() | F.coalesce(tag(tags, "route").isin(*FERRIES), F.lit(False))


def _holds(value: Column, listed: tuple[str, ...]) -> Column:
    """Whether a value or a part of a `;` list is listed; null for no value. One expression without lambdas, as it runs for every way."""
    return value.rlike(f"(^|;)({'|'.join(map(re.escape, listed))})(;|$)")


def _any_in(value: Column, yes: tuple[str, ...], no: tuple[str, ...]) -> Column:
    """true, false or null for a value or `;` list: of a list a yes wins wherever it stands, then a no."""
    return F.when(_holds(value, yes), True).when(_holds(value, no), False)


def car_access(tags: Column) -> Column:
    """'no', 'destination' or 'yes': the road's class or ferry allows, bans clear it, the nearest vehicle key overrides, private values make it destination-only."""
    highway = tag(tags, "highway")
    allowed = F.coalesce(highway.isin(*CAR_ROADS), F.lit(False)) | F.coalesce(tag(tags, "route").isin(*FERRIES), F.lit(False))
    ban = (F.coalesce(tag(tags, "impassable"), F.lit("")) == "yes") | (F.coalesce(tag(tags, "smoothness"), F.lit("")) == "impassable")
    ban = ban | ~F.coalesce(_any_in(tag(tags, "access"), ACCESS_YES, ACCESS_NO), F.lit(True))
    override = F.coalesce(*[_any_in(tag(tags, k), VEHICLE_YES, VEHICLE_NO) for k in ("motorcar", "motor_vehicle", "vehicle")])
    can = F.coalesce(override, allowed & ~ban)
    private = F.lit(False)
    for k in ("access", "motor_vehicle", "motorcar", "vehicle"):
        private = private | F.coalesce(_holds(tag(tags, k), PRIVATE), F.lit(False))
    return F.when(F.coalesce(highway, F.lit("")) == "construction", "no").when(~can, "no").when(private, "destination").otherwise("yes")


def destination_only(tags: Column) -> Column:
    """Tags that let cars in only for a destination; a way that is shut stays as it is."""
    closed = lambda t: F.map_concat(F.map_filter(t, lambda k, _: k != "motorcar"), F.create_map(F.lit("motorcar"), F.lit("destination")))
    return F.when(car_access(tags) == "yes", closed(tags)).otherwise(tags)


def maxspeed(value: Column, zones: dict[str, int] | None = None, low: int = 5, high: int = 150) -> Column:
    """km/h of one readable value in range; null for lists, words and anything unsure."""
    def read(v: Column) -> Column:
        plain = F.regexp_replace(F.lower(v), " ", "")
        number = F.regexp_replace(plain, "(km/h|kmh|kph|mph)$", "")
        kmh = number.try_cast("double") * F.when(plain.endswith("mph"), MPH).otherwise(1.0)
        for zone, speed in (zones or {}).items():
            kmh = F.when(v == zone, F.lit(float(speed))).otherwise(kmh)
        return let(F.when(~F.isnan(kmh) & (F.abs(kmh) < 1e6), F.bround(kmh, 0).cast("int")), lambda k: F.when(k.between(low, high), k))

    return let(values(value), lambda got: F.when(F.size(got) == 1, read(F.get(got, F.lit(0)))))


def direction(value: Column) -> Column:
    """struct<kind, value> of a direction: along (+1, -1), degrees, both; null where there is none."""
    kind = lambda k, v: F.struct(F.lit(k).alias("kind"), v.cast("double").alias("value"))

    def read(v: Column) -> Column:
        point = F.array_position(F.array(*map(F.lit, COMPASS)), F.upper(v))
        degrees = F.when(point > 0, (point - 1) * 22.5).otherwise(v.try_cast("double"))
        none = F.lit(None).cast("struct<kind:string,value:double>")
        return F.when(F.lower(v) == "forward", kind("along", F.lit(1))).when(F.lower(v) == "backward", kind("along", F.lit(-1))).when(F.lower(v).isin("both", "all"), kind("both", F.lit(None))).when(
            degrees.isNotNull() & ~F.isnan(degrees) & (F.abs(degrees) < 1e9), kind("degrees", F.pmod(degrees, F.lit(360.0)))).otherwise(none)

    return let(values(value), lambda got: F.when(F.size(got) > 1, kind("both", F.lit(None))).when(F.size(got) == 1, read(F.get(got, F.lit(0)))))


def oneway(tags: Column) -> Column:
    """1 along the way, -1 against it, 0 both ways."""
    v = F.lower(F.coalesce(F.try_element_at(tags, F.lit("oneway")), F.lit("")))
    implied = (F.coalesce(tag(tags, "highway"), F.lit("")) == "motorway") | F.coalesce(tag(tags, "junction").isin("roundabout", "circular"), F.lit(False))
    return F.when(v.isin("yes", "true", "1"), 1).when(v.isin("-1", "reverse"), -1).when(v.isin("no", "false", "0", "alternating", "reversible"), 0).when(implied, 1).otherwise(0)


def road_matches(tags: Column, ref: str | None = None, name: str | None = None) -> Column:
    """A `;` list of refs that holds the wanted one, or the very name."""
    out = F.lit(False)
    if ref is not None:
        out = out | F.array_contains(values(F.try_element_at(tags, F.lit("ref"))), ref)
    if name is not None:
        out = out | F.coalesce(F.try_element_at(tags, F.lit("name")) == name, F.lit(False))
    return out


def tile_road(kind: Column, subclass: Column, roads: tuple[str, ...], paths: tuple[str, ...] = ()) -> Column:
    """The class of a tile's road, its `_construction` ending aside; null for other classes and for paths."""
    base = F.regexp_replace(kind, "_construction$", "")
    return F.when(base.isin(*roads) & ~F.coalesce(subclass.isin(*paths) if paths else F.lit(False), F.lit(False)), base)


def clamp01(v: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))
