"""Rules and weights of builds and searches. The numbers are this engine's own choice."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class BuildConfig:
    place_kinds: dict[str, tuple[float, float]] = field(default_factory=lambda: {"city": (0.7, 15.0), "town": (0.5, 8.0), "village": (0.3, 4.0), "hamlet": (0.2, 2.0), "suburb": (0.35, 3.0)})
    districts: tuple[str, ...] = ("suburb",)
    population_full: float = 1_000_000.0
    population_weight: float = 0.25
    capital_bonus: float = 0.2
    wikidata_bonus: float = 0.02
    parent_weight: float = 0.2
    street_classes: dict[str, float] = field(default_factory=lambda: {"motorway": 1.0, "trunk": 0.9, "primary": 0.8, "secondary": 0.7, "tertiary": 0.6, "residential": 0.4, "service": 0.2, "track": 0.1})
    street_cluster_m: float = 600.0
    street_merge_m: float = 2000.0
    street_weights: tuple[float, float, float] = (0.4, 0.3, 0.3)  # class, length, city
    length_full_m: float = 20_000.0
    address_link_m: float = 1500.0
    address_dedup_m: float = 60.0
    address_weights: tuple[float, float, float, float] = (0.05, 0.2, 0.2, 0.02)  # base, city, street, building
    poi_rules: tuple[dict, ...] = (
        {"kind": "fuel", "group": "car", "prior": 0.5, "match": [{"amenity": ["fuel"]}]},
        {"kind": "cafe", "group": "food", "prior": 0.3, "match": [{"amenity": ["cafe", "restaurant"]}], "named": True},
        {"kind": "hotel", "group": "sleep", "prior": 0.4, "match": [{"tourism": ["hotel"]}]},
        {"kind": "peak", "group": "nature", "prior": 0.2, "match": [{"natural": ["peak"]}], "named": True},
        {"kind": "border_control", "group": "travel", "prior": 0.6, "match": [{"barrier": ["border_control"]}]},
    )
    poi_dedup_m: float = 150.0
    poi_bonuses: tuple[float, float, float] = (0.1, 0.05, 0.02)  # named, brand, wikidata
    line_checkpoint_m: float = 3000.0
    camera_road_m: float = 40.0
    camera_dedup_m: float = 50.0
    turn_deg: float = 30.0
    hazard_kinds: dict[str, str] = field(default_factory=lambda: {"bump": "bump", "hump": "bump", "table": "bump", "level_crossing": "rail"})


@dataclass(frozen=True)
class SearchConfig:
    exact: float = 1.0
    stem: float = 0.9
    prefix_last: float = 0.8
    prefix: float = 0.6
    coverage: float = 0.3
    optional_bonus: float = 0.05
    type_missing: float = 0.9
    text: float = 0.7
    importance: float = 0.3
    near: float = 0.3
    near_km: float = 10.0
    occupied_factor: float = 0.9
    margin: float = 0.01
    per_table: int = 80
    local: int = 80
    local_box_deg: float = 0.3
    limit: int = 10
    categories: tuple[tuple[str, str], ...] = (("petrol", "fuel"), ("fuel", "fuel"), ("cafe", "cafe"), ("restaurant", "cafe"), ("hotel", "hotel"))
    #: Of a category's word, starts that aren't it (a park is no car park), and what a kind must have besides.
    not_starts: tuple[tuple[str, str], ...] = ()
    attributes: tuple[tuple[str, str], ...] = ()
    per_category: int = 20
    near_km_of: tuple[tuple[str, float], ...] = ()
    #: Words for kinds of streets by group, those of lanes, and what they count.
    type_groups: tuple[tuple[str, tuple[str, ...]], ...] = (("street", ("street", "avenue", "ქუჩა", "გამზირი", "улица", "проспект")), ("road", ("highway", "road", "გზატკეცილი", "шоссе")), ("district", ("district", "რაიონი", "район")))
    lane_words: tuple[str, ...] = ("lane", "dead end", "შესახვევი", "ჩიხი", "переулок", "тупик")
    type_conflict: float = 0.7
    lane_factor: float = 0.9
    initial_bonus: float = 0.03
    #: What a row gains or loses beside its text: in the named settlement, a street that only has a place's name, a number that no name has.
    city_bonus: float = 0.1
    named_like_place: float = 0.8
    number_not_in_name: float = 0.6
    class_prior: tuple[tuple[str, float], ...] = (("primary", 0.02), ("secondary", 0.01))
    elsewhere_penalty: float = 0.1
    elsewhere_margin: float = 0.05
    settlements: tuple[str, ...] = ("city", "town", "village", "hamlet", "suburb")
    features: tuple[str, ...] = ("peak", "border_control")
    exact_groups: tuple[str, ...] = ("district",)
    reach_km: tuple[tuple[str, float], ...] = (("city", 15.0), ("town", 8.0), ("village", 4.0), ("hamlet", 3.0), ("suburb", 3.0))
    anchor_same_km: float = 15.0
    anchor_least_text: float = 0.9
